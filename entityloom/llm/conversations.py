"""Conversations brought back to alternating turns at least cost, by a suffix-shared automaton.

The rows of a conversation become a string of symbols, its signature: role initial and fault of
each row in order.  Edits are to keep a row, rewrite its role, delete it, or insert an empty one, and the
role initials that remain must read ``(s?(ua)+)?``.  What the rest of a conversation costs depends only
on the rest of its signature and on where in that pattern it starts, so signatures are merged
from their end: they are sorted by their reversed text, and the nodes of a common suffix lie on a
stack while the signatures that share it pass by.  A node holds, for each of the four states of the
pattern, the cost to the end and the first edit of the best audit there; suffixes whose nodes would
be alike share one, so each is solved once.  An edit has one successor state: the audit is a walk.

Nothing whole passes one task but what the result asks for: faults are found by aggregations
that combine on the map side, rows are ordered by a range sort, and a conversation's rows are collected
only as symbols, one byte a row.  The digest of a repaired conversation is taken over its rows as they
stream by.

Defined results.  A NULL in conv_id or turn counts as one space where rows are hashed for damage, NULL
role and text are one space; the rows without conv_id are one conversation, returned as NULL, and rows
without a turn come first.  Rows of one turn are ordered by role, then by the SHA-256 of their text;
equal rows are duplicates of the first of them.  A role without s, u or a as its first character (an
empty one too) fits nowhere and is rewritten or deleted.  An empty table gives an empty result;
columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityloom.llm.common import staged_rows, with_uid

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
#: From each state: the state after a user or an assistant row, whichever may follow.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: A row that must be deleted; other symbols are s, u, a or o (any other role), capitals if truncated.
MUST = "x"
_FAR = 1 << 60
_ARROW_ROWS = 10_000


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults planted by a checksum of conversation and turn.

    Returns conv_id, turn, role, text and copies: how often the row stands there (0: dropped).
    """
    blank = F.lit(" ")
    name = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(name("text"), "[.!?]", "")).otherwise(name("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(name("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _symbols(rows: DataFrame) -> DataFrame:
    """(uid, conv_id, turn, role, text_hash, copies, initial, blank, truncated, seen): no texts.

    ``seen``: an earlier row of the conversation has the same role and text.
    """
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    initial = F.substring("role", 1, 1)
    facts = with_uid(rows).select(
        "uid",
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2("text", 256)).alias("text_hash"),
        "copies",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("truncated"),
    )
    facts = staged_rows(facts, "conversation-rows")
    # The first of equal rows: a minimum combined on the map side, brought back on the row's own number.
    first = (
        facts.filter("copies > 0 and not blank")
        .groupBy("conv_id", "role", "text_hash")
        .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "uid")).alias("m"))
        .select(F.col("m.uid").alias("uid"), F.lit(False).alias("seen"))
    )
    return facts.join(first, "uid", "left").withColumn("seen", F.coalesce("seen", ~F.col("blank") & (F.col("copies") > 0)))


_PIECE = (
    "conv_id {conv}, part long, signature string, initials string, first_turn {turn}, last_turn {turn}, "
    "n_turns long, blank long, duplicate long, truncated long"
)


class _Piece:
    """A stretch of one conversation in the sorted rows."""

    def __init__(self, conv, part: int):
        self.conv, self.part = conv, part
        self.signature, self.initials = [], []
        self.first = self.last = None
        self.n_turns = self.blank = self.duplicate = self.truncated = 0

    def add(self, turn, copies: int, initial: str, blank: bool, truncated: bool, seen: bool) -> None:
        if turn is not None and turn != self.last:
            self.n_turns += 1
            self.first = turn if self.first is None else self.first
            self.last = turn
        must = blank or seen
        self.blank += copies if blank else 0
        self.duplicate += 0 if blank else copies - 1 + seen
        self.truncated += truncated and not must
        self.signature += [MUST if must else initial.upper() if truncated else initial, MUST * (copies - 1)]
        self.initials.append(initial * copies)

    def row(self) -> tuple:
        return (
            *(self.conv, self.part, "".join(self.signature), "".join(self.initials)),
            *(self.first, self.last, self.n_turns, self.blank, self.duplicate, self.truncated),
        )


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of one conversation in sorted rows, as signatures and counts."""
    names = ["conv_id", "part", "signature", "initials", "first_turn", "last_turn", "n_turns", "blank", "duplicate", "truncated"]
    read = ["conv_id", "part", "turn", "copies", "initial", "blank", "truncated", "seen"]
    out, piece, types = [], None, None
    for batch in batches:
        conv, turn = batch.column("conv_id").type, batch.column("turn").type
        types = [conv, pa.int64(), pa.string(), pa.string(), turn, turn, *[pa.int64()] * 4]
        for c, part, t, copies, *facts in zip(*(batch.column(n).to_pylist() for n in read), strict=True):
            if piece is None or c != piece.conv:
                out += [piece.row()] if piece else []
                piece = _Piece(c, part)
            if copies:
                piece.add(t, copies, *facts)
        if len(out) >= _ARROW_ROWS:
            yield _batch(out, names, types)
            out = []
    if piece:
        yield _batch([*out, piece.row()], names, types)


def signatures(rows: DataFrame) -> DataFrame:
    """(conv_id, signature, gaps, blank, duplicate, truncated, illegal) of damaged ``rows``."""
    kinds = dict(rows.dtypes)
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text_hash", "uid"]
    keyed = staged_rows(_symbols(rows), "conversation-symbols")
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ordered.withColumn("part", F.monotonically_increasing_id()).mapInArrow(
        _pieces, _PIECE.format(conv=kinds["conv_id"], turn=kinds["turn"])
    )
    # Few conversations lie across parts of the sort; their pieces are one short string each.
    whole = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("part", "signature", "initials", "first_turn", "last_turn", "n_turns"))).alias("p"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
    )
    joined = lambda c: F.array_join(f"p.{c}", "")
    turned = F.filter("p", lambda p: p["first_turn"].isNotNull())
    # A turn that goes on in the next piece was counted in both.
    split = F.size(
        F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(turned) - 1, F.lit(1))),
            lambda k: F.get(turned, k - 1)["last_turn"] == F.get(turned, k)["first_turn"],
        )
    )
    n_turns = F.aggregate("p", F.lit(0).cast("long"), lambda n, p: n + p["n_turns"]) - split
    gaps = F.array_max("p.last_turn") - F.array_min("p.first_turn") + 1 - n_turns
    initials = joined("initials")
    pairs = F.length(initials) - 1 - F.regexp_count(initials, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    return whole.select(
        "conv_id",
        joined("signature").alias("signature"),
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        "blank",
        "duplicate",
        "truncated",
        F.greatest(pairs, F.lit(0)).cast("long").alias("illegal"),
    )


class Node:
    """What can follow: for each state how much dearer it is than the best one, and its first edit.

    ``edits[state]`` is K, R, D, I or empty at the end; ``rise`` is what the best state costs more
    than that of the node after.  Suffixes that differ in nothing but their cost so far share a node,
    so there are few, and each is solved once.
    """

    __slots__ = ("costs", "edits", "rise", "before")

    def __init__(self, base: list[tuple[int, str]]):
        best = list(base)
        # Inserting leads to another state of this same suffix; more than two in a row lead back.
        for _ in range(2):
            for state in range(4):
                best[state] = min(base[state], (INSERT + best[NEXT[state]][0], "I"))
        self.rise = min(cost for cost, _ in best)
        self.costs = tuple(cost - self.rise for cost, _ in best)
        self.edits = tuple(edit for _, edit in best)
        self.before: dict[str, Node] = {}

    def with_row(self, symbol: str) -> Node:
        """The node of the suffix that has one row more in front."""
        if symbol not in self.before:
            self.before[symbol] = self._solved(symbol)
        return self.before[symbol]

    def _solved(self, symbol: str) -> Node:
        base = []
        late = TRUNCATED if symbol.isupper() else 0
        for state in range(4):
            options = [(DELETE + self.costs[state], "D")]
            if symbol != MUST:
                options.append((REROLE + late + self.costs[NEXT[state]], "R"))
                to = successor(state, symbol)
                if to is not None:
                    options.append((KEEP + late + self.costs[to], "K"))
            base.append(min(options))
        made = Node(base)
        return _NODES.setdefault((made.costs, made.edits, made.rise), made)


_NODES: dict[tuple, Node] = {}
_END = Node([(0, ""), (_FAR, ""), (_FAR, ""), (0, "")])


def audit_of(path: list[Node], backwards: str) -> str:
    """The edits from the start of the pattern on, the least in ASCII among the cheapest."""
    out, k, state = [], len(path) - 1, START
    while edit := path[k].edits[state]:
        out.append(edit)
        if edit == "K":
            state = successor(state, backwards[k - 1])
        elif edit in "RI":
            state = NEXT[state]
        k -= edit != "I"
    return "".join(out)


def successor(state: int, symbol: str) -> int | None:
    """The state after a row kept as it is, None where the pattern does not allow it."""
    role = symbol.lower()
    if role == "s":
        return SYSTEM if state == START else None
    wanted = {"u": USER, "a": ASSISTANT}.get(role)
    return wanted if wanted == NEXT[state] else None


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost and audit of signatures that come sorted by their reversed text."""
    path, total, last, answer = [_END], 0, "", None
    for batch in batches:
        costs, audits = [], []
        for backwards in batch.column("backwards").to_pylist():
            if answer is None or backwards != last:
                shared = _common(last, backwards)
                total -= sum(node.rise for node in path[shared + 1 :])
                del path[shared + 1 :]
                for symbol in backwards[shared:]:
                    path.append(path[-1].with_row(symbol))
                    total += path[-1].rise
                last, answer = backwards, (total + path[-1].costs[START], audit_of(path, backwards))
            costs.append(answer[0])
            audits.append(answer[1])
        keep = [i for i, c in enumerate(batch.schema.names) if c != "backwards"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in keep), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            [*(batch.schema.names[i] for i in keep), "cost", "audit"],
        )


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = (np.frombuffer(s[:n].encode("ascii"), np.uint8) for s in (a, b))
    return int(np.argmax(x != y))


def solved(conversations: DataFrame) -> DataFrame:
    """``conversations`` (with signature) and their cost and audit.

    Equal signatures are neighbours in the sort, and a frequent one is dealt to several parts by conv_id.
    """
    backwards = F.reverse("signature")
    order = ["backwards", "conv_id"]
    ranged = conversations.withColumn("backwards", backwards).drop("signature").repartitionByRange(*order)
    fields = ", ".join(f"`{n}` {t}" for n, t in ranged.dtypes if n != "backwards")
    return ranged.sortWithinPartitions(*order).mapInArrow(_answers, f"{fields}, cost long, audit string")


def repaired_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) of the repaired conversation, from its damaged rows in order."""
    state = START
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield NAMES[state], ""
            continue
        role, text = next(rows)
        if edit == "R":
            state = NEXT[state]
            yield NAMES[state], text
        elif edit == "K":
            state = successor(state, role[:1])
            yield role, text


def _digests(facts: list[str]):
    """One row for each conversation: its facts, and the SHA-256 of its repaired rows as they pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []

        def flat() -> Iterator[tuple]:
            for batch in batches:
                types[:] = [batch.schema.field(c).type for c in facts]
                heads, copies, roles, texts = (batch.column(c).to_pylist() for c in ("head", "copies", "role", "text"))
                for i, head in enumerate(heads):
                    if head:
                        yield tuple(batch.column(c)[i].as_py() for c in facts), None, None
                    for _ in range(0 if head else copies[i]):
                        yield None, roles[i], texts[i]

        stream, audit, out = flat(), facts.index("audit"), []
        upcoming = next(stream, None)
        while upcoming is not None:
            head, upcoming = upcoming[0], None

            def body() -> Iterator[tuple[str, str]]:
                nonlocal upcoming
                for row in stream:
                    if row[0] is not None:
                        upcoming = row
                        return
                    yield row[1:]

            rows, sha, mark = body(), hashlib.sha256(), ""
            for role, text in repaired_rows(head[audit], rows):
                sha.update(f"{mark}{role}:{text}".encode())
                mark = "\n"
            next(rows, None)  # all rows are used; this meets the next head
            out.append((*head, sha.hexdigest()))
            if len(out) >= _ARROW_ROWS:
                yield _batch(out, [*facts, "repaired_sha256"], [*types, pa.string()])
                out = []
        if out:
            yield _batch(out, [*facts, "repaired_sha256"], [*types, pa.string()])

    return run


def _lined_up(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """Each conversation's repair, then its rows in order, as neighbours in one part."""
    facts = repairs.columns
    narrow = rows.filter("copies > 0").select(
        "conv_id", F.lit(False).alias("head"), "turn", "role", "text", "copies", F.unhex(F.sha2("text", 256)).alias("text_hash")
    )
    lined = repairs.withColumn("head", F.lit(True)).unionByName(narrow, allowMissingColumns=True)
    order = [F.col("conv_id"), F.col("head").desc(), F.col("turn").asc_nulls_first(), "role", "text_hash"]
    return lined.repartition("conv_id").sortWithinPartitions(*order).select(*facts, "head", "role", "text", "copies")


def repair_plan(rows: DataFrame) -> DataFrame:
    """Faults, cost and audit of each conversation in ``rows`` (conv_id, turn, role, text, copies)."""
    return solved(staged_rows(signatures(rows), "conversation-signatures"))


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the repaired conversations; ``turn`` counts from 0."""

    names = ["conv_id", "turn", "role", "text"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, audit, conv, state, at, done, types = [], "", None, START, 0, 0, None

        def inserts() -> None:
            nonlocal state, at, done
            while at < len(audit) and audit[at] == "I":
                state, at = NEXT[state], at + 1
                out.append((conv, done, NAMES[state], ""))
                done += 1

        for batch in batches:
            types = [batch.column("conv_id").type, pa.int64(), pa.string(), pa.string()]
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "head", "audit", "role", "text", "copies")]
            for c, head, a, role, text, copies in zip(*columns, strict=True):
                if head:
                    inserts()
                    audit, conv, state, at, done = a, c, START, 0, 0
                    continue
                for _ in range(copies):
                    inserts()
                    edit, at = audit[at], at + 1
                    if edit != "D":
                        state = NEXT[state] if edit == "R" else successor(state, role[:1])
                        out.append((conv, done, NAMES[state] if edit == "R" else role, text))
                        done += 1
            yield _batch(out, names, types)
            out.clear()
        inserts()
        if out:
            yield _batch(out, names, types)

    kind = dict(rows.dtypes)["conv_id"]
    plan = staged_rows(repair_plan(rows).select("conv_id", "audit"), "conversation-repairs")
    return _lined_up(rows, plan).mapInArrow(apply, f"conv_id {kind}, turn long, role string, text string")


def repairs_with_digest(rows: DataFrame) -> DataFrame:
    """``repair_plan`` with ``repaired_sha256``: of the repaired ``role:text``, joined by newlines."""
    plan = staged_rows(repair_plan(rows), "conversation-repairs")
    fields = ", ".join(f"`{n}` {t}" for n, t in plan.dtypes)
    return _lined_up(rows, plan).mapInArrow(_digests(plan.columns), f"{fields}, repaired_sha256 string")
