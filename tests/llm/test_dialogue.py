"""Conversation repair against plain recursion, plain Python over whole tables, and odd input."""

import hashlib
import itertools
import zlib
from functools import cache

import numpy as np
import pytest

from platewise.llm import dialogue
from platewise.llm.queries import op13_dialogue_repair

SPACE = " \t\n\x0b\f\r"
NEXT = {("start", "s"): "lead", ("start", "u"): "user", ("lead", "u"): "user", ("user", "a"): "done", ("done", "u"): "user"}


def plain_repair(turns):
    """(cost, audit) of turns (initial, must go, truncated) by recursion over the grammar's states, without lengths."""
    @cache
    def best(i, state, inserts):
        found = []
        if i == len(turns) and state in ("start", "done"):
            found.append((0, ""))
        if i < len(turns):
            initial, gone, cut = turns[i]
            c, a = best(i + 1, state, 0)
            found.append((c + 4, "D" + a))
            if not gone:
                for role in dict.fromkeys([initial, "u", "a"]):
                    if (state, role) in NEXT:
                        c, a = best(i + 1, NEXT[state, role], 0)
                        found.append((c + 3 * cut + 3 * (role != initial), ("K" if role == initial else "R") + a))
        if inserts < 2:
            for role in "ua":
                if (state, role) in NEXT:
                    c, a = best(i, NEXT[state, role], inserts + 1)
                    found.append((c + 3, "I" + a))
        return min(found, default=(10 ** 9, ""))
    return best(0, "start", 0)


def plain_query(rows):
    """op13 over (conv_id, turn, role, text) in plain Python."""
    convs = {}
    for conv, turn, role, text in rows:
        one = " " if turn is None else turn
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{one}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        mine = convs.setdefault(conv, [])
        if fault != 0:
            text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
            mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, mine in convs.items():
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        known = [t for t, _, _ in mine if t is not None]
        seen, faults, coded = set(), [0, 0, 0], []
        for _, role, text in mine:
            bare = text.strip(SPACE)
            kind = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if kind is not None:
                faults[kind] += 1
            coded.append((role[:1], kind in (0, 1), kind == 2))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(coded, coded[1:]))
        cost, audit = plain_repair(tuple(coded))
        lines, left = [], [(r, t) for _, r, t in mine]
        size = len(audit) - audit.count("D")
        target = ("s" if size % 2 else "") + "ua" * (size // 2)
        names = {"u": "user", "a": "assistant"}
        for letter in audit:
            role, text = ("", "") if letter == "I" else left.pop(0)
            if letter != "D":
                lines.append(f"{role if letter == 'K' else names[target[len(lines)]]}:{text}")
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def codes_of(turns):
    return "".join(chr(65 + 4 * "usax".find(r) + f) for r, f in turns)


def plain_of(turns):
    return plain_repair(tuple((r, f >= 2, f == 1) for r, f in turns))


def test_all_short_conversations():
    kinds = list(itertools.product("usax", (0, 1, 2)))
    for n in (1, 2, 3):
        for turns in itertools.product(kinds, repeat=n):
            found = dialogue.Alignment(codes_of(turns))
            assert (found.cost, dialogue.audit_of(found.actions())) == plain_of(turns), turns


def test_long_conversations(monkeypatch):
    rng = np.random.default_rng(5)
    for slack in (12, 4):
        monkeypatch.setattr(dialogue, "START_SLACK", slack)
        for _ in range(150):
            n = int(rng.integers(4, 60))
            turns = [(str(rng.choice(list("uuuaaasx"))), int(rng.choice([0, 0, 0, 0, 1, 2, 3]))) for _ in range(n)]
            if rng.random() < 0.5:
                turns = [("us"[i == 0] if i % 2 else "sa"[i > 0], f) if rng.random() < 0.9 else (r, f) for i, (r, f) in enumerate(turns)]
            found = dialogue.Alignment(codes_of(turns))
            assert (found.cost, dialogue.audit_of(found.actions())) == plain_of(turns), turns


def test_actions_are_cut_at_turns():
    assert dialogue._cut("UKADuA", [1, 2]) == ["UK", "ADuA"]
    assert dialogue._cut("KKK", [1, 1, 1]) == ["K", "K", "K"]


def test_query_equals_plain_python(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in op13_dialogue_repair(spark, folder).collect()}
    assert got == plain_query(rows)


@pytest.fixture
def odd_rows():
    rng = np.random.default_rng(8)
    texts = ["Hi.", "no end", "  ", "", None, "Hi.", "Tail!\n", "é?", "x" * 5000 + ".", "...", "a\x00b."]
    roles = ["user", "assistant", "system", None, "", "tool"]
    rows = [(c if c < 9 else None, None if rng.random() < 0.1 else int(rng.integers(0, 12)), roles[rng.integers(len(roles))],
             texts[rng.integers(len(texts))]) for c in rng.integers(0, 10, 400).tolist()]
    hot = [(77, t, "user" if t % 2 else "assistant", f"turn {t % 350}.") for t in range(700)]
    dropped = next(i for i in range(10 ** 6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return rows + [r for r in rows[:20]] + hot + [(dropped, 0, "user", "gone.")]


def test_odd_rows(spark, odd_rows, tmp_path):
    frame = spark.createDataFrame(odd_rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as place", "'clash' as edits", "2 as run", "3 as fault", "'x' as same")
    frame.repartition(7).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in op13_dialogue_repair(spark, str(tmp_path)).collect()}
    assert got == plain_query(odd_rows)


def test_repaired_turns_are_what_the_digest_covers(spark, odd_rows):
    frame = spark.createDataFrame(odd_rows, "conv_id long, turn long, role string, text string")
    found = dialogue.repair(dialogue.damaged(frame))
    lines = {}
    for r in dialogue.repaired_turns(found).orderBy("conv_id", "run", "number").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    sums = {r["conv_id"]: r["repaired_sha256"] for r in dialogue.repaired_digests(found).collect()}
    assert sums == {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in sums}


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert op13_dialogue_repair(spark, str(tmp_path)).count() == 0
