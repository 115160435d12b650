import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest
from entityloom.llm import conversations as C
from entityloom.llm import queries

BLANK = re.compile(r"[\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        seen_before = (role, text) in seen
        seen.add((role, text))
        bare = BLANK.sub("", text)
        out.append("blank" if not bare else "duplicate" if seen_before else "truncated" if bare[-1] not in ".!?" else "")
    return out


def cheapest(rows, kinds):
    """(cost, audit, repaired rows) by search over positions and the last two roles, whole strings compared."""

    @lru_cache(None)
    def best(i, out, inserts):
        # ``out`` is what the pattern still depends on: '' (nothing), 's', 'u', 'a'.
        options = []
        if i == len(rows) and out in ("", "a"):
            options.append((0, "", ()))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[out]
        names = {"u": "user", "a": "assistant"}
        if inserts < 3:
            for o in follow.replace("s", ""):
                cost, audit, rest = best(i, o, inserts + 1)
                options.append((cost + 2, "I" + audit, ((names[o], ""), *rest)))
        if i < len(rows):
            (role, text), late = rows[i], kinds[i] == "truncated"
            cost, audit, rest = best(i + 1, out, 0)
            options.append((cost + 3, "D" + audit, rest))
            if kinds[i] not in ("blank", "duplicate"):
                for o in follow:
                    if role[:1] == o:
                        cost, audit, rest = best(i + 1, o, 0)
                        options.append((cost + late, "K" + audit, ((role, text), *rest)))
                    if o != "s":
                        cost, audit, rest = best(i + 1, o, 0)
                        options.append((cost + late + 2, "R" + audit, ((names[o], text), *rest)))
        return min(options, key=lambda x: x[:2]) if options else (10**9, "~", ())

    for i in range(len(rows), 0, -20):  # from the end, so that the recursion stays flat
        best(i, "a", 0)
    return best(0, "", 0)


def brute(table):
    out = []
    for conv in {c for c, *_ in table}:
        rows = []
        for _, turn, role, text in [r for r in table if r[0] == conv]:
            name = " " if conv is None else str(conv)
            kind = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
            role, text = " " if role is None else role, " " if text is None else text
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest())
        rows.sort(key=order)
        turns = {t for t, *_ in rows if t is not None}
        pairs = [(t[1], x) for t, x in zip(rows, rows[1:], strict=False) for x in [x[1]]]
        rows = [r[1:] for r in rows]
        kinds = faults(rows)
        cost, audit, kept = cheapest(tuple(rows), tuple(kinds))
        assert PATTERN.fullmatch("".join(r[0] for r, _ in kept))
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                *(kinds.count(k) for k in ("blank", "duplicate", "truncated")),
                sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in pairs),
                cost,
                audit,
                hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
            )
        )
    return out


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def key(r):
    return tuple(map(str, r))


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: df["turn"] for c in ("uid", "head", "copies", "AUDIT", "signature", "part")})


def some_table(seed, n=150):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "Why? ", "é!\n", "", " \t", "ok.", "a.b", "...", "?\x0b", "x" * 50_000 + ".", " "]
    rows = []
    for conv in range(n):
        turns = list(range(rng.randrange(9)))
        if rng.random() < 0.3:
            turns = [t * rng.choice([1, 2]) for t in turns]
        for t in turns:
            role = rng.choice(["system", "user", "assistant", "tool", "User", "", "agent"]) if rng.random() < 0.3 else "ua"[t % 2]
            role = {"u": "user", "a": "assistant"}.get(role, role)
            rows.append((conv, t, role, rng.choice(texts) if rng.random() < 0.5 else f"text {conv} {t}."))
    rows += [(1000, None, "user", "a."), (1000, None, None, None), (1000, 3, "user", None), (None, 1, "user", "a."), (None, 2, None, "b.")]
    rows += [(1001, None, "user", "a."), (1002, 5, "user", "b."), (1002, 5, "user", "b."), (1002, 5, "assistant", "a.")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_brute_force(spark, tmp_path, seed):
    rows = some_table(seed)
    # One conversation of many rows, which lies across several parts of the sort.
    rng = random.Random(seed)
    rows += [(7777, t, rng.choice(["user", "assistant"]), rng.choice(["same.", f"t{t}.", f"t{t}"])) for t in range(300)]
    frame(spark, rows).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op13_conversation_repair(spark, str(tmp_path)).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows), key=key)


def test_all_short_signatures():
    """Every signature of up to 5 rows against whole search, suffixes shared as in a sorted run."""
    symbols = "sUaox"
    every = sorted(("".join(p) for n in range(6) for p in itertools.product(symbols, repeat=n)), key=lambda s: s[::-1])
    path, total, last = [C._END], 0, ""
    for signature in every:
        back = signature[::-1]
        shared = C._common(last, back)
        total -= sum(n.rise for n in path[shared + 1 :])
        del path[shared + 1 :]
        for symbol in back[shared:]:
            path.append(path[-1].with_row(symbol))
            total += path[-1].rise
        last = back
        roles = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
        rows = tuple((roles[c.lower()], f"{i}") for i, c in enumerate(signature))
        kinds = tuple({"x": "blank", "U": "truncated"}.get(c, "") for c in signature)
        cost, audit, kept = cheapest(rows, kinds)
        assert (total + path[-1].costs[C.START], C.audit_of(path, back)) == (cost, audit)
        assert list(C.repaired_rows(audit, iter(rows))) == list(kept)
    assert len(C._NODES) < 300


def test_repaired_rows(spark):
    rows = spark.createDataFrame(
        [(1, 0, "user", "a.", 1), (1, 1, "user", "b.", 1), (2, 0, "assistant", "c.", 2), (3, 0, "user", "d.", 0)],
        "conv_id long, turn long, role string, text string, copies int",
    )
    got = sorted(map(tuple, C.repaired(rows).collect()))
    assert got == [(1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "user", ""), (2, 1, "assistant", "c.")]


def test_empty_table(spark):
    got = C.repairs_with_digest(C.damaged(frame(spark, [(1, 1, "user", "x")]).limit(0)))
    assert got.collect() == [] and got.columns == COLUMNS


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, folder).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(table), key=key)
