"""One evaluator for all rules: selectors, moves and targets are data, not expressions.

The shredder leaves an index with each page: key (``div``, ``.word``, ``@attribute``) -> positions of the
elements that have it.  A rule becomes a literal record that names, for each of its selectors, the key to
look up; the evaluator probes the index, tests only the elements found there, and moves on from
those.  So a page is not walked once for each rule, and the plan has the same size
whatever the number of rules and sources: a new source lengthens a literal.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from entityloom.functions import text as tx
from entityloom.operators.shred import first_piece_of, text_of

if TYPE_CHECKING:
    from entityloom.operators.extract import Move, Part, Rule, Sel

_SEL = (
    "struct<keys:array<string>,tags:array<string>,cls:array<string>,attrs:array<struct<name:string,value:string>>,"
    "text:string,ends:string,holds:string>"
)
_PART = f"struct<moves:array<struct<how:string,sel:{_SEL},nth:int>>,take:string,steps:array<string>>"
RULES_TYPE = (
    f"array<struct<item:{_SEL},value:{_PART},label:{_PART},fields:map<string,string>,to:string,within:array<{_SEL}>,in_all:boolean,"
    f"first_only:boolean,all_values:boolean,count_sel:{_SEL},count:int,having:{_SEL}>>"
)
#: Moves that look for a selector; the others follow a pointer.
_SEARCHES = ("find", "following", "preceding")
_FACT = "struct<field:string,label:string,value:string>"


class BadRule(ValueError):
    """A rule that cannot be evaluated."""


def _sel(sel: Sel | None) -> dict[str, Any] | None:
    if sel is None:
        return None
    tags = (sel.tag,) if isinstance(sel.tag, str) else sel.tag
    # The rarest of what must hold: a class word, else an attribute, else the tags.
    keys = [f".{sel.cls[0]}"] if sel.cls else [f"@{next(iter(sel.attrs))}"] if sel.attrs else list(tags or ())
    if not keys:
        raise BadRule(f"a selector needs a tag, a class or an attribute: {sel}")
    return {
        "keys": keys,
        "tags": list(tags) if tags else None,
        "cls": list(sel.cls),
        "attrs": [{"name": n, "value": v} for n, v in sel.attrs.items()],
        "text": sel.text.upper() if sel.text is not None else None,
        "ends": sel.ends,
        "holds": sel.holds,
    }


def _move(move: Move) -> dict[str, Any]:
    if move.how not in (*_SEARCHES, "parent", "next"):
        raise BadRule(f"no move is named {move.how}")
    if move.how in _SEARCHES and move.sel is None:
        raise BadRule(f"{move.how} needs a selector")
    return {"how": move.how, "sel": _sel(move.sel), "nth": move.nth}


def _part(part: Part | None, steps: dict[str, Callable[[Column], Column]]) -> dict[str, Any] | None:
    if part is None:
        return None
    for step in part.steps:
        if step not in steps:
            raise BadRule(f"no step is named {step}")
    return {"moves": [_move(m) for m in part.moves], "take": part.take, "steps": list(part.steps)}


def compiled(rules: tuple[Rule, ...], steps: dict[str, Callable[[Column], Column]]) -> str:
    """Rules as JSON of ``RULES_TYPE``; raises ``BadRule`` for one that has no meaning."""
    out = []
    for r in rules:
        if r.in_all and len(r.within) != 1:
            raise BadRule("in_all needs one enclosing selector")
        if r.label is None and r.to is None:
            raise BadRule("a rule needs a label or a target")
        sel, n = r.count or (None, None)
        out.append(
            {
                "item": _sel(r.item),
                "value": _part(r.value, steps),
                "label": _part(r.label, steps),
                "fields": r.fields,
                "to": r.to,
                "within": [_sel(s) for s in r.within],
                "in_all": r.in_all,
                "first_only": r.first_only,
                "all_values": r.all_values,
                "count_sel": _sel(sel),
                "count": n,
                "having": _sel(r.having),
            }
        )
    return json.dumps(out, ensure_ascii=False)


def rules_literal(packs_json: dict[str, str], source: Column) -> Column:
    """The compiled rules of the row's source, NULL where there are none; one constant for all rows."""
    text = "{" + ",".join(f"{json.dumps(s)}:{r}" for s, r in packs_json.items()) + "}"
    return F.try_element_at(F.from_json(F.lit(text), f"map<string,{RULES_TYPE}>"), source)


def _known(text: Column) -> Column:
    """``tx.blank_to_null``, reading the text once: inside a lambda that names it twice, Spark would read it twice."""
    return tx.let(tx.strip(text), lambda t: F.when(t != "", t))


class Evaluator:
    """Expressions over one shredded page: ``elements``, ``texts`` and ``index``."""

    def __init__(self, elements: Column, texts: Column, index: Column, steps: dict[str, Callable[[Column], Column]]):
        self.elements, self.texts, self.index, self.steps = elements, texts, index, steps

    def matches(self, e: Column, sel: Column) -> Column:
        text = lambda: tx.strip(text_of(self.texts, e))
        has = lambda a: tx.let(
            F.try_element_at(e["attrs"], a["name"]), lambda v: v.isNotNull() & (a["value"].isNull() | (v == a["value"]))
        )
        return F.coalesce(
            (sel["tags"].isNull() | F.array_contains(sel["tags"], e["tag"]))
            & F.forall(sel["cls"], lambda c: F.array_contains(e["classes"], c))
            & F.forall(sel["attrs"], has)
            & (sel["text"].isNull() | (F.upper(text()) == sel["text"]))
            & (sel["holds"].isNull() | F.contains(text_of(self.texts, e), sel["holds"]))
            & (sel["ends"].isNull() | F.endswith(text(), sel["ends"])),
            F.lit(False),
        )

    def hits(self, sel: Column, low: Column, high: Column) -> Column:
        """Elements between two positions that match, in order."""
        found = F.flatten(F.transform(sel["keys"], lambda k: F.coalesce(F.try_element_at(self.index, k), F.array().cast("array<int>"))))
        places = F.when(F.size(sel["keys"]) > 1, F.array_sort(found)).otherwise(found)
        inside = F.filter(places, lambda p: (p >= low) & (p <= high))
        return F.filter(F.transform(inside, lambda p: F.get(self.elements, p)), lambda e: self.matches(e, sel))

    def below(self, sel: Column, e: Column) -> Column:
        return self.hits(sel, e["pos"] + 1, e["last"])

    def go(self, e: Column, move: Column) -> Column:
        """The element a move leads to, or NULL."""

        def near(up: Column) -> Column:
            # A fragment without an enclosing element: its siblings stand at the top.
            first, last = F.coalesce(up["pos"], F.lit(-1)), F.coalesce(up["last"], F.size(self.elements) - 1)
            low = F.when(move["how"] == "following", e["last"] + 1).otherwise(first + 1)
            high = F.when(move["how"] == "following", last).otherwise(e["pos"] - 1)
            siblings = F.filter(self.hits(move["sel"], low, high), lambda x: x["parent"].eqNullSafe(e["parent"]))
            return F.try_element_at(siblings, F.when(move["how"] == "following", 1).otherwise(-1))

        return (
            F.when(e["pos"].isNull(), F.lit(None))
            .when(move["how"] == "parent", F.get(self.elements, e["parent"]))
            .when(move["how"] == "next", F.get(self.elements, e["next"]))
            .when(move["how"] == "find", F.get(self.below(move["sel"], e), move["nth"] - 1))
            .otherwise(tx.let(F.get(self.elements, e["parent"]), near))
        )

    def read(self, item: Column, part: Column) -> Column:
        """The text a part reads from an item."""

        def step(value: Column, name: Column) -> Column:
            out = F.when(F.lit(False), value)
            for known, apply in self.steps.items():
                out = out.when(name == known, apply(value))
            return out

        def finish(e: Column) -> Column:
            taken = (
                F.when(part["take"] == "text", tx.strip(text_of(self.texts, e)))
                .when(part["take"] == "first", tx.strip(first_piece_of(self.texts, e)))
                .otherwise(F.try_element_at(e["attrs"], F.substring(part["take"], F.lit(2), F.length(part["take"]))))
            )
            return F.when(e["pos"].isNotNull(), F.aggregate(part["steps"], taken, step))

        return tx.let(F.aggregate(part["moves"], item, self.go), finish)

    def items(self, rule: Column) -> Column:
        """Elements that a rule reads."""
        size = F.size(self.elements)
        page = F.struct(F.lit(0).alias("low"), (size - 1).alias("high"))
        nowhere = F.struct(F.lit(1).alias("low"), F.lit(0).alias("high"))

        def narrow(scope: Column, sel: Column) -> Column:
            first = F.get(self.hits(sel, scope["low"], scope["high"]), F.lit(0))
            return tx.let(first, lambda s: F.when(s["pos"].isNull(), nowhere).otherwise(F.struct((s["pos"] + 1).alias("low"), s["last"].alias("high"))))

        single = tx.let(F.aggregate(rule["within"], page, narrow), lambda s: self.hits(rule["item"], s["low"], s["high"]))
        scopes = tx.let(F.get(rule["within"], F.lit(0)), lambda sel: self.hits(sel, F.lit(0), size - 1))
        every = F.flatten(F.transform(scopes, lambda s: self.below(rule["item"], s)))
        found = F.when(rule["in_all"], every).otherwise(single)
        kept = F.filter(
            found,
            lambda i: (rule["count"].isNull() | (F.size(self.below(rule["count_sel"], i)) == rule["count"]))
            & (rule["having"].isNull() | (F.size(self.below(rule["having"], i)) > 0)),
        )
        return F.when(rule["first_only"] & rule["label"].isNull(), F.slice(kept, 1, 1)).otherwise(kept)

    def facts(self, rules: Column) -> Column:
        """What the rules read on the page: ``array<struct<field,label,value>>``, NULL without rules."""

        def fact(item: Column, rule: Column) -> Column:
            value = _known(self.read(item, rule["value"]))
            label = F.when(rule["label"].isNotNull(), self.read(item, rule["label"]))
            return tx.let(
                label,
                lambda lab: F.struct(
                    F.when(rule["label"].isNull(), rule["to"]).otherwise(F.try_element_at(rule["fields"], lab)).alias("field"),
                    lab.alias("label"),
                    value.alias("value"),
                ),
            )

        def of_rule(rule: Column) -> Column:
            def listed(items: Column) -> Column:
                joined = _known(F.array_join(F.transform(items, lambda i: self.read(i, rule["value"])), ","))
                whole = F.array(F.struct(rule["to"].alias("field"), F.lit(None).cast("string").alias("label"), joined.alias("value")))
                each = F.transform(items, lambda i: fact(i, rule))
                # Reversed, so that "the last fact of a field wins" keeps the first match.
                ordered = F.when(rule["first_only"] & rule["label"].isNotNull(), F.reverse(each)).otherwise(each)
                return F.when(rule["all_values"], whole).otherwise(ordered)

            return tx.let(self.items(rule), listed)

        return F.flatten(F.transform(rules, of_rule)).cast(f"array<{_FACT}>")
