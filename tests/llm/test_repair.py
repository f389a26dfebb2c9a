import hashlib
import itertools
import random
import zlib

import pytest
from oracle import same

from pageloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def brute(kinds, rows, most=2):
    """Least (cost, audit) over all edits with up to ``most`` insertions in each gap, and the rows they give."""
    import re

    found = []
    for inserts in itertools.product(range(most + 1), repeat=len(kinds) + 1):
        gaps = ["I" * n for n in inserts]
        for letters in itertools.product("KRD", repeat=len(kinds)):
            audit = gaps[0] + "".join(a + g for a, g in zip(letters, gaps[1:], strict=True))
            cost, made, i, bad = 0, "", 0, False
            options = [("", [])]
            for a in audit:
                if a == "I":
                    cost += 3
                    options = [(m + x, out + [(r, "")]) for m, out in options for x, r in (("u", "user"), ("a", "assistant"))]
                    continue
                kind, (role, text), i = kinds[i], rows[i], i + 1
                if a == "D":
                    cost += 4
                    continue
                bad |= kind == "d"
                cost += (3 if a == "R" else 0) + (3 if kind.isupper() else 0)
                if a == "K":
                    options = [(m + (role[:1] or "?"), out + [(role, text)]) for m, out in options]
                else:
                    options = [(m + x, out + [(r, text)]) for m, out in options for x, r in (("u", "user"), ("a", "assistant"))]
            for made, out in options:
                if not bad and re.fullmatch("(s?(ua)+)?", made):
                    found.append((cost, audit, out))
    return min(found, key=lambda x: x[:2])


def plain(rows):
    """The contract, conversation by conversation."""
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, [])
        f = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if f == 0:
            continue
        text = "" if f == 1 else text.translate({ord(c): None for c in ".!?"}) if f == 2 else text
        talks[conv] += [(turn, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    return talks


def test_viterbi_against_all_edits():
    chance = random.Random(5)
    for _ in range(60):
        kinds = "".join(chance.choice("suaxSUAXd") for _ in range(chance.randint(0, 3)))
        rows = [({"s": "system", "u": "user", "a": "assistant"}.get(k.lower(), "tool"), f"t{i}") for i, k in enumerate(kinds)]
        cost, audit, out = brute(kinds, rows)
        assert repair.cheapest(kinds) == (cost, audit), kinds
        replay = repair.Replay(audit)
        for role, text in rows:
            replay.row(role, text)
        assert replay.end() == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def test_pieces_compose_to_the_whole():
    chance = random.Random(6)
    for _ in range(200):
        kinds = "".join(chance.choice("suaxSUAXd") for _ in range(chance.randint(0, 40)))
        layer, at = repair.start(), 0
        while at < len(kinds):
            to = at + chance.randint(1, 9)
            layer = repair.compose(layer, repair.matrix(kinds[at:to]))
            at = to
        assert repair.best(layer) == repair.cheapest(kinds)


def _random_rows(seed, n, convs=6):
    chance = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "no", "", " \t", "Why?\n", "stop!", "é…", None, "a. b", "same."]
    return [(chance.choice([None, *range(convs)]), chance.choice([None, *range(40)]), chance.choices(roles, [2, 9, 9, 1, 1, 1])[0], chance.choice(texts) if i % 3 else f"own {i}.") for i in range(n)]


@pytest.mark.parametrize("piece_rows", [1, 3, 1024])
def test_query_against_sql_with_ties_nulls_and_pieces(spark, piece_rows):
    rows = _random_rows(piece_rows, 150)
    rows += [(77, 3, "user", "x.")] * 3
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = repair.repaired(repair.damaged(frame), piece_rows=piece_rows)
    same(got, repair.ORACLE_SQL, {"conversations": frame})


def test_long_conversation_in_many_pieces(spark):
    chance = random.Random(9)
    rows = [(1, i, chance.choice(["user", "assistant"]), chance.choice(["same.", f"own {i}.", "cut"])) for i in range(400)] + [(2, i, "user", "a.") for i in range(5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = {tuple(r) for r in repair.repaired(repair.damaged(frame)).collect()}
    assert {tuple(r) for r in repair.repaired(repair.damaged(frame), piece_rows=7).collect()} == want
    # held to the layers taken one by one
    for conv, talk in plain(rows).items():
        kinds, seen = "", set()
        for _, role, text in talk:
            bare = text.rstrip(SPACE)
            kinds += "d" if not bare or (role, text) in seen else role[0] if bare[-1] in ".!?" else role[0].upper()
            seen.add((role, text))
        layer = repair.start()
        for k in kinds:
            layer = repair.step(layer, k)
        row = next(r for r in want if r[0] == conv)
        assert (row[6], row[7]) == repair.best(layer)


def test_all_rows_dropped_empty_table_and_extra_columns(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA).selectExpr("*", "1 as digest", "2 as _i", "3 as rows", "4 as done")
    assert [tuple(r) for r in repair.repaired(repair.damaged(frame)).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repair.repaired(repair.damaged(frame.limit(0))).count() == 0
