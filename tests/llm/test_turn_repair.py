"""Conversation repair against a plain backward search over whole edit strings."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from cartwheel.llm import queries, turn_repair
from cartwheel.llm.common import importable

SCHEMA = "conv_id long, turn long, role string, text string, extra int, position int"


def conversations():
    """Random roles and texts, repeated and blank turns, nulls in every column, long conversations of one role."""
    rng = random.Random(3)
    out = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "user", "assistant"])
            text = rng.choice(["One. ", "Two!", "cut off", "", " \t", None, "é?\n", "same."]) or None
            out.append((conv, turn if rng.random() > 0.1 else None, role, text, 1, 2))
    out += [(100, t, "user", f"line {t}.", 1, 2) for t in range(300)]
    out += [(101, t, "assistant" if t % 3 else "system", f"line {t}.", 1, 2) for t in range(150)]
    out += [(102, 0, "user", "x" * 300_000 + ".", 1, 2), (102, 7, "assistant", "ok.", 1, 2), (102, 7, "assistant", "ok.", 1, 2)]
    gone = next(c for c in range(200, 900) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out.append((gone, 0, "user", "All of it is dropped.", 1, 2))
    rng.shuffle(out)
    return out


def plain_damage(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        own = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for k, v in by.items()}


def plain_repair(rows):
    """The contract's values of one conversation; every suffix is kept as a whole (cost, edits, turns)."""
    seen, flags = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        flags.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    ok = re.compile(r"(s?(ua)+)?")
    step = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserts):
        """Least (cost, edits, repaired turns) from turn i on, after a turn of initial ``last``."""
        options = []
        if i == len(rows) and last in ("", "a"):
            options.append((0, "", ()))
        targets = [r for r in ("user", "assistant") if r[0] in step[last]]
        if inserts:
            for r in targets:
                c, e, t = best(i, r[0], inserts - 1)
                options.append((c + 5, "I" + e, ((r, ""), *t)))
        if i < len(rows):
            _, role, text = rows[i]
            c, e, t = best(i + 1, last, 3)
            options.append((c + 2, "D" + e, t))
            if flags[i] not in ("blank", "duplicate"):
                more = 5 * (flags[i] == "truncated")
                if role[:1] and role[0] in step[last]:
                    c, e, t = best(i + 1, role[0], 3)
                    options.append((c + more, "K" + e, ((role, text), *t)))
                for r in targets:
                    if r[0] != role[:1]:
                        c, e, t = best(i + 1, r[0], 3)
                        options.append((c + 1 + more, "R" + e, ((r, text), *t)))
        return min(options, key=lambda o: o[:2]) if options else (10**9, "", ())

    for i in range(len(rows), -1, -1):
        for last in step:
            for k in range(4):
                best(i, last, k)
    cost, audit, turns = best(0, "", 3)
    if not rows:
        cost, audit, turns = 0, "", ()
    assert ok.fullmatch("".join(r[0] for r, _ in turns))
    numbers = [t for t, *_ in rows if t is not None]
    roles = [r[:1] for _, r, _ in rows]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            *(flags.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())


@pytest.mark.parametrize("parts", [1, 5])
def test_repair_equals_whole_string_search(spark, tmp_path, parts):
    rows = conversations()
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r)[1:] for r in queries.op13_turn_repair(spark, str(tmp_path)).collect()}
    assert got == {k: plain_repair(v) for k, v in plain_damage(rows).items()}
    assert any(v[6] == "" for v in got.values()) and {c for v in got.values() for c in v[6]} == set("KRD")


def test_nothing(spark, tmp_path):
    importable(spark)
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert queries.op13_turn_repair(spark, str(tmp_path)).count() == 0


def test_resolved_edits_leave_memory():
    """A plain conversation is resolved turn by turn; what is held does not grow with it."""
    work, most, done = turn_repair.Repairer(), 0, 0
    for t in range(5_000):
        done += sum(1 for _ in work.push(t, "assistant" if t % 2 else "user", "ok.", 0))
        most = max(most, len(work.pending))
    assert most <= 16 and done + sum(1 for _ in work.finish()) == 5_000


def test_repair_gives_turns(spark):
    """The operator's own output: edits with the repaired turns."""
    importable(spark)
    rows = [(1, 0, "assistant", "Hi.", 0, 0), (1, 1, "user", "Why?", 0, 0), (1, 2, "assistant", "So", 0, 0)]
    got = turn_repair.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("position").collect()
    assert [(r.edit, r.role_before, r.role, r.text, r.fault) for r in got] == [
        ("R", "assistant", "user", "Hi.", 0), ("R", "user", "assistant", "Why?", 0), ("D", "assistant", None, None, 3)]
