"""Rules as data, and their evaluation as Spark expressions over shredded pages.

A ``Rule`` says where labelled items stand on a page, how to read the label and the
value of one item, and which field each label feeds.  ``extract`` hands the rules of all
sources as a literal to one evaluator (``rules``): the work is map-only, and the plan does not grow
with their number.  A new source is a new ``SourceRules`` value; no code.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityloom.functions import text as tx
from entityloom.functions import urls
from entityloom.operators.rules import Evaluator, compiled, rules_literal
from entityloom.operators.shred import first_piece_of, text_of


@dataclass(frozen=True)
class Sel:
    """Matches elements by tag(s), class words, attributes and own text."""

    tag: str | tuple[str, ...] | None = None
    cls: tuple[str, ...] = ()
    attrs: dict[str, str | None] = field(default_factory=dict)
    text: str | None = None
    ends: str | None = None
    holds: str | None = None


@dataclass(frozen=True)
class Move:
    """A step from one element to another: ``find`` (nth match below), ``parent``, ``next``
    (sibling), ``following`` or ``preceding`` (nearest sibling that matches ``sel``)."""

    how: str
    sel: Sel | None = None
    nth: int = 1


PARENT, NEXT = Move("parent"), Move("next")


@dataclass(frozen=True)
class Part:
    """Where to read a text, starting from an item, and what to make of it.

    ``take`` is ``text``, ``first`` (first text piece of the element itself) or the name
    of an attribute written as ``@name``; ``steps`` are names from ``STEPS``.
    """

    moves: tuple[Move, ...] = ()
    take: str = "text"
    steps: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    """One kind of item.  Without a label the value feeds ``to``, else ``fields[label]``.

    ``within`` narrows to the first match of each selector in turn, or with ``in_all`` to
    every match of the only one.  ``first_only`` keeps the first fact of a field (otherwise
    the last), ``all_values`` joins the values of all items, ``count`` asks for that many
    matches below an item, ``having`` for one at any depth.
    """

    item: Sel
    value: Part = Part()
    label: Part | None = None
    fields: dict[str, str] = field(default_factory=dict)
    to: str | None = None
    within: tuple[Sel, ...] = ()
    in_all: bool = False
    first_only: bool = False
    all_values: bool = False
    count: tuple[Sel, int] | None = None
    having: Sel | None = None


@dataclass(frozen=True)
class SourceRules:
    """Everything the engine knows about one source.

    ``listing`` is (selector, attribute, enclosing selectors) of profile links, ``sub_page``
    the ending of a second page of the same profile.
    """

    source: str
    domain: str
    rules: tuple[Rule, ...]
    listing: tuple[Sel, str, tuple[Sel, ...]]
    sub_page: str | None = None


def _social_token(c: Column) -> Column:
    """``…link-Twitter')`` or ``…button-Twitter')`` -> ``twitter``."""
    after_link = F.get(F.split(c, "link-"), F.lit(1))
    after_button = F.get(F.split(c, "button-"), F.lit(1))
    return F.lower(F.regexp_replace(F.coalesce(after_link, after_button), r"[^\w]", ""))


def _icon_token(c: Column) -> Column:
    """Second class word, the part after its first dash: ``fab fa-github`` -> ``github``."""
    word = F.get(F.split(F.trim(c), r"\s+"), F.lit(1))
    return F.lower(F.get(F.split(word, "-"), F.lit(1)))


# Named steps a rule may apply to a label or a value.
STEPS: dict[str, Callable[[Column], Column]] = {
    "strip": tx.strip,
    "upper": F.upper,
    "lower": F.lower,
    "first_line": lambda c: F.substring_index(c, "\n", 1),
    "no_colon": lambda c: F.replace(c, F.lit(":"), F.lit("")),
    "before_bracket": tx.before,
    "between_colons": tx.between_colons,
    "before_slash": lambda c: tx.fraction_numerator(c).cast("string"),
    "percent": lambda c: tx.style_percent(c).cast("string"),
    "host": urls.social_host,
    "social_token": _social_token,
    "icon_token": _icon_token,
    "fold": lambda c: F.translate(c, "С", "C"),  # Cyrillic capital Es -> Latin C
}


def matches(e: Column, texts: Column, sel: Sel) -> Column:
    tests = []
    if sel.tag is not None:
        tags = (sel.tag,) if isinstance(sel.tag, str) else sel.tag
        tests.append(e["tag"].isin(*tags))
    tests += [F.array_contains(e["classes"], c) for c in sel.cls]
    for name, wanted in sel.attrs.items():
        have = F.try_element_at(e["attrs"], F.lit(name))
        tests.append(have.isNotNull() if wanted is None else have == wanted)
    if sel.text is not None:
        tests.append(F.upper(tx.strip(text_of(texts, e))) == sel.text.upper())
    if sel.holds is not None:
        tests.append(F.contains(text_of(texts, e), F.lit(sel.holds)))
    if sel.ends is not None:
        tests.append(F.endswith(tx.strip(text_of(texts, e)), F.lit(sel.ends)))
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return F.coalesce(out, F.lit(False))


def below(elements: Column, e: Column) -> Column:
    """All descendants of an element: they stand right behind it."""
    return F.slice(elements, e["pos"] + 2, e["last"] - e["pos"])


def find_all(elements: Column, texts: Column, sel: Sel, within: tuple[Sel, ...] = (), in_all: bool = False) -> Column:
    """Elements that match, inside the first match of each enclosing selector in turn."""
    if not within:
        return F.filter(elements, lambda e: matches(e, texts, sel))
    if in_all:
        scopes = F.filter(elements, lambda e: matches(e, texts, within[0]))
        return F.flatten(F.transform(scopes, lambda s: F.filter(below(elements, s), lambda e: matches(e, texts, sel))))
    none = F.slice(elements, 1, 0)

    def narrow(part: Column, outer: tuple[Sel, ...]) -> Column:
        if not outer:
            return F.filter(part, lambda e: matches(e, texts, sel))
        scope = F.get(F.filter(part, lambda e: matches(e, texts, outer[0])), F.lit(0))
        inner = tx.let(scope, lambda s: F.when(s["pos"].isNotNull(), below(elements, s)).otherwise(none))
        return tx.let(inner, lambda sub: narrow(sub, outer[1:]))

    return narrow(elements, within)


def find(elements: Column, texts: Column, sel: Sel, within: tuple[Sel, ...] = ()) -> Column:
    return F.get(find_all(elements, texts, sel, within), F.lit(0))


def take(elements: Column, texts: Column, e: Column, what: str) -> Column:
    if what == "text":
        return tx.strip(text_of(texts, e))
    if what == "first":
        return tx.strip(first_piece_of(texts, e))
    return F.try_element_at(e["attrs"], F.lit(what.removeprefix("@")))


def go(elements: Column, texts: Column, e: Column, move: Move) -> Column:
    """The element a move leads to, or NULL."""
    fits = lambda x: matches(x, texts, move.sel) if move.sel is not None else F.lit(True)
    if move.how in ("parent", "next"):
        return F.get(elements, e[move.how])
    if move.how == "find":
        return F.get(F.filter(below(elements, e), fits), F.lit(move.nth - 1))

    def sibling(up: Column) -> Column:
        # A fragment without an enclosing element: its siblings stand at the top.
        first, last = F.coalesce(up["pos"], F.lit(-1)), F.coalesce(up["last"], F.size(elements) - 1)
        near = lambda x: x["parent"].eqNullSafe(e["parent"]) & fits(x)
        if move.how == "following":
            return F.get(F.filter(F.slice(elements, e["last"] + 2, last - e["last"]), near), F.lit(0))
        return F.try_element_at(F.filter(F.slice(elements, first + 2, e["pos"] - first - 1), near), F.lit(-1))

    return tx.let(F.get(elements, e["parent"]), sibling)


def read_part(elements: Column, texts: Column, item: Column, part: Part) -> Column:
    def finish(e: Column) -> Column:
        value = take(elements, texts, e, part.take)
        for step in part.steps:
            value = STEPS[step](value)
        return F.when(e["pos"].isNotNull(), value)

    def walk(e: Column, moves: tuple[Move, ...]) -> Column:
        if not moves:
            return finish(e)
        return tx.let(go(elements, texts, e, moves[0]), lambda there: walk(there, moves[1:]))

    return walk(item, part.moves)


def _last_per_field(facts: Column) -> Column:
    """``map<field,value>``; a later fact replaces an earlier one."""
    usable = F.filter(facts, lambda f: f["field"].isNotNull() & f["value"].isNotNull())

    def collapse(known: Column) -> Column:
        names = F.array_distinct(F.transform(known, lambda f: f["field"]))
        pair = lambda n: F.struct(
            n.alias("key"), F.try_element_at(F.filter(known, lambda f: f["field"] == n), F.lit(-1))["value"].alias("value")
        )
        return F.map_from_entries(F.transform(names, pair))

    return tx.let(usable, collapse)


_PARTS = ("elements", "texts", "index")


def extract(shredded: DataFrame, packs: tuple[SourceRules, ...], source: str = "source") -> DataFrame:
    """Replace the parts of pages shredded with an index by ``raw`` (field -> text) and ``unmapped`` facts.

    ``unmapped`` holds labelled values no rule knows a field for; they go to the rejects.
    """
    page = Evaluator(F.col("elements"), F.col("texts"), F.col("index"), STEPS)
    rules = rules_literal({p.source: compiled(p.rules, STEPS) for p in packs}, F.col(source))
    carried = [c for c in shredded.columns if c not in _PARTS]
    with_facts = shredded.select(*carried, page.facts(rules).alias("facts"))
    # An item may be read by several rules; its label is unknown if none of them maps it.
    mapped = F.transform(F.filter(F.col("facts"), lambda f: f["field"].isNotNull()), lambda f: f["label"])
    unknown = tx.let(
        mapped,
        lambda known: F.filter(
            F.col("facts"),
            lambda f: f["field"].isNull() & f["label"].isNotNull() & ~F.coalesce(F.array_contains(known, f["label"]), F.lit(False)),
        ),
    )
    return with_facts.select(*carried, _last_per_field(F.col("facts")).alias("raw"), unknown.alias("unmapped"))


def unmapped_labels(extracted: DataFrame, *keys: str) -> DataFrame:
    """One row per labelled value that feeds no field."""
    rows = extracted.select(*keys, F.explode("unmapped").alias("f"))
    return rows.select(*keys, F.col("f.label").alias("label"), F.col("f.value").alias("value"))


def lookup(targets: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for kv in targets.items() for v in kv])


def classify(text: Column, targets: dict[str, str]) -> Column:
    """Field of a link by its text, title, host or token; NULL where none fits."""
    return F.try_element_at(lookup(targets), text)


def listing_links(shredded: DataFrame, packs: tuple[SourceRules, ...], source: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """Profile links of listing pages: ``source``, ``url``, one row each, made absolute."""
    elements, texts = F.col("elements"), F.col("texts")
    branches = []
    for p in packs:
        sel, attr, within = p.listing
        hrefs = F.transform(find_all(elements, texts, sel, within), lambda e: F.try_element_at(e["attrs"], F.lit(attr)))
        domain = F.lit(p.domain)
        branches.append((F.col(source) == p.source, F.transform(F.filter(hrefs, F.isnotnull), lambda h: urls.resolve(domain, h))))
    links = F.when(*branches[0])
    for branch in branches[1:]:
        links = links.when(*branch)
    return shredded.select(*keep, F.col(source).alias("source"), F.explode(links).alias("url"))
