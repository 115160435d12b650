"""The rule packs of the seven sources.

All selectors, labels and field targets below are fixed values: they must equal what the
sources write in their pages.
"""

from __future__ import annotations

from entityloom.operators.extract import NEXT, PARENT, Move, Part, Rule, Sel, SourceRules

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
HREF = Part(take="@href")
SRC = Part(take="@src")
UPPER_TEXT = Part(steps=("upper",))


def div(*words: str, **attrs: str) -> Sel:
    return Sel("div", words, attrs)


def first(to: str, item: Sel, *within: Sel, value: Part = Part()) -> Rule:
    return Rule(item, value, to=to, within=within, first_only=True)


BENCH = SourceRules(
    "icobench",
    "https://icobench.com",
    (
        first("name", Sel(HEADINGS), div("name")),
        first("description", div("name"), value=Part((PARENT, Move("following", Sel("p"))))),
        Rule(
            Sel("div"),
            Part(take="first"),
            Part((Move("find", Sel("label")),), steps=("upper",)),
            {
                "ICO PROFILE": "ico_profile_score",
                "VISION": "vision_score",
                "TEAM": "team_score",
                "PRODUCT": "product_score",
            },
            within=(div("rating"), div("distribution")),
        ),
        first("website_overall_rating", div(itemprop="ratingValue"), value=Part(take="@content")),
        Rule(
            Sel("label"),
            Part((Move("following", div("number")),)),
            UPPER_TEXT,
            {"TIME": "_time", "PREICO TIME": "_pre_time", "STATUS": "_status"},
            within=(div("financial_data"),),
            first_only=True,
        ),
        Rule(
            Sel("label"),
            Part((Move("following", div("number")), NEXT)),
            UPPER_TEXT,
            {"TIME": "_time_range", "PREICO TIME": "_pre_range", "STATUS": "_status_range"},
            within=(div("financial_data"),),
            first_only=True,
        ),
        Rule(
            div("data_row"),
            Part((Move("find", Sel("div"), 2),)),
            Part((Move("find", Sel("div")),), steps=("upper",)),
            {
                "TOKEN": "ticker",
                "PREICO PRICE": "pre_ico_token_price",
                "PRICE": "ico_token_price",
                "PRICE IN ICO": "ico_token_price",
                "PLATFORM": "platform",
                "ACCEPTING": "accepted_currencies",
                "SOFT CAP": "soft_cap",
                "HARD CAP": "hard_cap",
                "COUNTRY": "country",
                "RESTRICTED AREAS": "countries_restricted",
                "ICO START": "_row_start",
                "ICO END": "_row_end",
                "PREICO START": "_row_pre_start",
                "PREICO END": "_row_pre_end",
                "WHITELIST/KYC": "_flags",
            },
            within=(div("financial_data"),),
        ),
        Rule(
            Sel("a", attrs={"title": None, "href": None}),
            HREF,
            UPPER_TEXT,
            {
                "FACEBOOK": "facebook_page",
                "GITHUB": "github_page",
                "MEDIUM": "medium_page",
                "TELEGRAM": "telegram_page",
                "REDDIT": "reddit_page",
                "BITCOINTALK": "btc_page",
                "WWW": "web_page",
                "LINKEDIN": "linkedin_page",
                "TWITTER": "twitter_page",
            },
            within=(div("socials"),),
        ),
        first("logo", Sel("img"), div("image"), value=SRC),
    ),
    listing=(Sel("a", ("image",), {"href": None}), "href", ()),
)

DROPS_ICONS = {
    "fa-facebook-square": "facebook_page",
    "fa-telegram": "telegram_page",
    "fa-medium": "medium_page",
    "fa-twitter": "twitter_page",
    "fa-github": "github_page",
    "fa-btc": "btc_page",
    "fa-reddit-alien": "reddit_page",
    "fa-youtube": "youtube_page",
}
DROPS = SourceRules(
    "icodrops",
    "https://icodrops.com",
    (
        first("name", Sel("h3"), div("ico-main-info")),
        first("whitepaper", Sel("div", ("button",), text="WHITEPAPER"), value=Part((PARENT,), "@href")),
        first("web_page", Sel("div", ("button",), text="WEBSITE"), value=Part((PARENT,), "@href")),
        first("description", div("ico-description")),
        first("logo", div("ico-main-info"), value=Part((PARENT, Move("find", Sel("img"))), "@data-src")),
        *[
            Rule(Sel("a", attrs={"href": None}), Part(take="@href"), to=to, within=(div("soc_links"),), having=Sel("i", (icon,)))
            for icon, to in DROPS_ICONS.items()
        ],
        Rule(
            div("rating-box"),
            Part((Move("find", Sel("p"), 2),)),
            Part((Move("find", Sel("p")),), steps=("first_line", "strip", "upper")),
            {
                "HYPE RATE": "hype_score",
                "RISK RATE": "risk_score",
                "ROI RATE": "roi_score",
                "ICO DRPS SCORE": "website_overall_rating",
            },
            within=(div("rating-field"),),
            count=(Sel("p"), 2),
        ),
        first("_phrase", Sel("strong"), div("token-sale")),
        first("_range", Sel("h4", holds="Token Sale:")),
        Rule(
            Sel("span", ("grey",)),
            Part((PARENT,), steps=("between_colons",)),
            Part(steps=("upper", "fold")),
            {
                "TICKER:": "ticker",
                "TOKEN TYPE:": "standart",
                "ICO TOKEN PRICE:": "ico_token_price",
                "FUNDRAISING GOAL:": "soft_cap",
                "WHITELIST:": "_whitelist",
                "KNOW YOUR CUSTOMER (KYC):": "_kyc",
                "ACCEPTS:": "accepted_currencies",
                "CAN'T PARTICIPATE:": "countries_restricted",
            },
        ),
    ),
    listing=(Sel("a", attrs={"id": "ccc", "href": None}), "href", ()),
)

MARKS_HOSTS = {
    "bitcointalk.org": "btc_page",
    "facebook.com": "facebook_page",
    "twitter.com": "twitter_page",
    "t.me": "telegram_page",
    "reddit.com": "reddit_page",
    "github.com": "github_page",
    "medium.com": "medium_page",
    "linkedin.com": "linkedin_page",
}
MARKS = SourceRules(
    "icomarks",
    "https://icomarks.com",
    (
        first("name", Sel("h1", attrs={"itemprop": "name"})),
        first("logo", Sel("img", attrs={"itemprop": "url"}), value=SRC),
        first("website_overall_rating", div("ico-rating-overall")),
        Rule(
            div("ico-rating__item"),
            Part((PARENT, Move("find", div("ico-rating__circle")))),
            Part((Move("find", div("ico-rating__title")),), steps=("upper",)),
            {"ICO PROFILE": "ico_profile_score", "TEAM & ADVISORS": "team_score"},
        ),
        Rule(
            div("icoinfo-block__item"),
            Part((Move("find", Sel("span")), PARENT), steps=("between_colons",)),
            Part((Move("find", Sel("span")),), steps=("upper",)),
            {
                "COUNTRY:": "country",
                "PRICE:": "ico_token_price",
                "ACCEPTING:": "accepted_currencies",
                "SOFT CAP:": "soft_cap",
                "HARD CAP:": "hard_cap",
                "TICKER:": "ticker",
                "PLATFORM:": "platform",
                "TOKEN TYPE:": "standart",
                "PRE-SALE TIME:": "_pre_range",
                "ICO TIME:": "_range",
                "WHITELIST/KYC:": "_flags",
            },
            within=(div("icoinfo"),),
        ),
        first("web_page", Sel("span", text="Website:"), div("icoinfo"), value=Part((Move("following", Sel("a")),), "@href")),
        Rule(
            Sel("a", ("icoinfo-block__view",), {"href": None}),
            HREF,
            Part(take="@href", steps=("host",)),
            MARKS_HOSTS,
            within=(div("icoinfo"),),
        ),
        first("description", div("company-description")),
    ),
    listing=(Sel("a", ("icoListItem__title",)), "href", ()),
)

RATING_LINKS = {
    "FACEBOOK": "facebook_page",
    "GITHUB": "github_page",
    "MEDIUM": "medium_page",
    "INSTAGRAM": "instagram_page",
    "TELEGRAM": "telegram_page",
    "REDDIT": "reddit_page",
    "BTCTALK": "btc_page",
    "WEBSITE": "web_page",
    "LINKEDIN": "linkedin_page",
    "TWITTER": "twitter_page",
}
RATING = SourceRules(
    "icoratings",
    "https://icorating.com",
    (
        first("name", Sel("h1"), div("h1"), value=Part(steps=("before_bracket",))),
        Rule(
            Sel("span", ("title",)),
            Part((PARENT, Move("find", Sel("span", ("score",)))), steps=("before_slash",)),
            UPPER_TEXT,
            {"RISK SCORE": "risk_score", "HYPE SCORE": "hype_score"},
        ),
        Rule(
            Sel("span", ("title",)),
            Part((PARENT, Move("find", Sel("span", ("name",)))), steps=("upper",)),
            UPPER_TEXT,
            {"INVESTMENT RATING": "roi_score"},
        ),
        Rule(Sel("a", attrs={"target": "_blank"}), HREF, UPPER_TEXT, RATING_LINKS),
        first("logo", div("share"), value=Part((Move("preceding", Sel("img")),), "@src")),
        Rule(
            Sel("td", ends=":"),
            Part((NEXT,)),
            Part(),
            {
                "Description:": "description",
                "Pre-ICO start date:": "pre_ico_start",
                "Pre-ICO end date:": "pre_ico_end",
                "Hard cap:": "hard_cap",
                "ICO start date:": "ico_start",
                "ICO end date:": "ico_end",
                "Soft cap:": "soft_cap",
                "Ticker:": "ticker",
                "ICO Platform:": "platform",
                "Token price in USD:": "ico_token_price",
                "Accepted Currencies:": "accepted_currencies",
                "Country Limitations:": "countries_restricted",
                "Token Standard:": "standart",
                "Registration Country:": "country",
            },
        ),
    ),
    listing=(Sel("tr", attrs={"data-href": None}), "data-href", ()),
    sub_page="/details",
)

TOPS = SourceRules(
    "tokentops",
    "https://www.tokentops.com/",
    (
        first("name", Sel("h1", ("page-details__title",))),
        first("logo", Sel("img", ("page-details__logo",)), value=SRC),
        first("website_overall_rating", Sel("span", ("rating-text",)), div("rating_block")),
        Rule(
            Sel("a", attrs={"title": None, "href": None}),
            HREF,
            Part(take="@title"),
            {
                "Facebook": "facebook_page",
                "Github": "github_page",
                "Blog": "medium_page",
                "Telegram": "telegram_page",
                "Reddit": "reddit_page",
                "Bitcoin Talk": "btc_page",
                "Website": "web_page",
                "Linkedin": "linkedin_page",
                "Twitter": "twitter_page",
            },
            within=(div("page-details__main"),),
            first_only=True,
        ),
        Rule(
            div("page-details__info-row"),
            Part((Move("find", Sel("h3", ("page-details__info-title",))), Move("following", div("page-details__info-descr")))),
            Part((Move("find", Sel("h3", ("page-details__info-title",))),), steps=("upper",)),
            {
                "START DATE": "ico_start",
                "CLOSE DATE": "ico_end",
                "TOKEN SYMBOL": "ticker",
                "SMART CONTRACT BLOCKCHAIN": "platform",
                "AMOUNT RAISED": "raised",
            },
        ),
        first("description", Sel("h2"), div("show-more-wrap", "show-more--big2")),
        Rule(
            div("rat-stars"),
            Part((Move("find", Sel("span")),), "@style"),
            to="_stars",
            within=(div(id="section-review-block"),),
            in_all=True,
            all_values=True,
        ),
    ),
    listing=(Sel("a", attrs={"target": "_blank"}), "href", (div("upcoming-sec__main"),)),
)

TRACK_TOKENS = {
    "bitcointalk": "btc_page",
    "twitter": "twitter_page",
    "facebook": "facebook_page",
    "telegram": "telegram_page",
    "github": "github_page",
    "reddit": "reddit_page",
    "linkedin": "linkedin_page",
    "homepage": "web_page",
    "whitepaper": "whitepaper",
    "slack": "slack_page",
    "blog": "medium_page",
    "youtube": "youtube_page",
    "instagram": "instagram_page",
}
TRACK = SourceRules(
    "trackico",
    "https://www.trackico.io",
    (
        first("name", Sel("h1", ("h2",))),
        first("logo", Sel("img"), div("img-thumbnail", "align-self-center", "m-2"), value=SRC),
        first("description", div("fs-14")),
        Rule(
            Sel("th"),
            Part((Move("following", Sel("td")),)),
            Part(),
            {"Pre-Sale": "_pre_range", "Token Sale": "_range", "Token": "ticker"},
            first_only=True,
        ),
        Rule(
            Sel("th"),
            Part((Move("following", Sel("td")), Move("find", Sel("a")))),
            Part(),
            {"Country": "country", "Platform": "platform"},
            first_only=True,
        ),
        first("website_overall_rating", div("fs-60", "fw-400", "text-primary")),
        Rule(
            Sel("a", attrs={"onclick": None}),
            Part(take="@href", steps=("strip",)),
            Part(take="@onclick", steps=("social_token",)),
            TRACK_TOKENS,
            within=(div("flexbox", "flex-wrap"),),
        ),
    ),
    listing=(Sel("a", attrs={"href": None}), "href", (div("row", "equal-height"),)),
)

BAZAAR_ICONS = {
    "website": "web_page",
    "bitcointalk": "btc_page",
    "twitter": "twitter_page",
    "facebook": "facebook_page",
    "telegram": "telegram_page",
    "github": "github_page",
    "reddit": "reddit_page",
    "linkedin": "linkedin_page",
    "slack": "slack_page",
}
BAZAAR = SourceRules(
    "icobazaar",
    "https://icobazaar.com",
    (
        first("name", Sel("h1"), div("com-header__info")),
        first("description", Sel("p"), div("com-header__info")),
        first("logo", Sel("img"), div("com-header__logo"), value=SRC),
        first("website_overall_rating", div("ico-rating"), value=Part(take="@rating")),
        Rule(
            div("com-sidebar__info-line"),
            Part((Move("find", Sel("span", ("com-sidebar__info-value",))),)),
            Part((Move("find", Sel("span")),), steps=("no_colon", "strip", "lower")),
            {
                "start": "ico_start",
                "end": "ico_end",
                "cap": "hard_cap",
                "goal": "soft_cap",
                "price": "ico_token_price",
            },
        ),
        first("web_page", Sel("a"), div("com-sidebar"), value=HREF),
        Rule(
            div("com-rating__list-element"),
            Part((Move("find", div("progress-bar")), Move("find", Sel("span"))), "@style", ("percent",)),
            Part((Move("find", Sel("span")),), steps=("lower",)),
            {"team": "team_score"},
            within=(div("com-rating__list"),),
            first_only=True,
        ),
        Rule(
            Sel("a", attrs={"href": None}),
            Part(take="@href", steps=("strip",)),
            Part((Move("find", Sel("i")),), "@class", ("icon_token",)),
            BAZAAR_ICONS,
            within=(div("com-social"),),
        ),
    ),
    listing=(Sel("a", ("cell-link",)), "href", ()),
    sub_page="/community",
)

PACKS: tuple[SourceRules, ...] = (DROPS, BENCH, MARKS, RATING, TOPS, TRACK, BAZAAR)
