import random

import pytest

from pageloom.llm import repeats
from pageloom.llm.repeats import lcp_intervals, maximal_repeats, remove_repeats


def brute(docs, length):
    seen, out = set(), []
    for i, t in docs:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                hit[s : s + length] = b"\x01" * length
            seen.add(w)
        spans = sum(1 for k in range(len(b)) if hit[k] and (not k or not hit[k - 1]))
        out.append((-1 if i is None else i, len(b), sum(hit), spans, bytes(x for x, h in zip(b, hit, strict=True) if not h)))
    return out


def rows(frame):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in frame.collect())


def test_intervals():
    assert sorted(lcp_intervals([0, 2, 2, 0, 3])) == [(0, 0, 4), (2, 0, 2), (3, 3, 4)]
    found = {(x, r, tuple(sorted(m))) for x, r, m in maximal_repeats([(b"ba", b"XYcc"), (b"ba", b"XYcd"), (b"bz", b"XYq")], 3)}
    assert found == {(2, 3, (0, 1)), (1, 2, (0, 1, 2))}


@pytest.mark.parametrize("most", [4096, 3])
def test_against_brute_force(spark, monkeypatch, most):
    """Anchors with few contexts are sorted, ones with more meet by their windows."""
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", most)
    rng = random.Random(3)
    for length, gram, alphabet in ((12, 4, "ab"), (12, 5, "abcdé"), (20, 6, "a")):
        shared = ["".join(rng.choice("abcdefé") for _ in range(rng.randrange(5, 60))) for _ in range(6)]
        docs = []
        for i in range(60):
            t = ""
            while len(t) < 150:
                t += rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30)))
            docs.append((i, t[: rng.randrange(200)]))
        docs += [(100, None), (101, ""), (102, "a" * 500), (103, docs[0][1])]
        d = spark.createDataFrame([(*r, 5) for r in docs], "doc_id long, text string, lo int").repartition(3)
        assert rows(remove_repeats(d, length=length, gram=gram)) == sorted(brute(docs, length))


def test_whole_length_repeated_rows_and_nulls(spark):
    rng = random.Random(4)
    line = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    passage = line(40)
    docs = [(None, f"{line(9)} {passage}")] + [(i, f"{line(rng.randrange(40))} {passage} {line(rng.randrange(40))}") for i in range(80)]
    docs += [(200, line(30_000))] + [(201, docs[5][1]), (201, docs[5][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert rows(remove_repeats(d)) == sorted(brute(docs, 100))
    assert remove_repeats(d.limit(0)).count() == 0
