import hashlib
import random
import re
import time

from pageloom.llm.pii import find_pii, op10_pii_spans

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        t += x - 9 if x > 9 else x
    return t % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    bits = ["a@b.c", "a.b@c.d.e", "@", ".", "1", "255", "256", "0300", "4111 1111 1111 1111", "4111111111111111", "-", " ", "  ", "+49", "(0)", "é", "x_", "𝄞", "+1 555 123 4567", "10.0.0.1", "\n", "4242-4242-4242-4242", "a" * 30]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    texts += [None, "", "a@b.c_x@d.e", "1.2.3.4.5.6.7.8", "a@b..c", "IBAN DE89370400440532013000 end", "DE89370400440532013001", "SSN: 078-05-1120", "078-05-1120"]
    d = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    for r in op10_pii_spans(spark, str(tmp_path)).collect():
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (texts[r.doc_id], want, r)
        assert [x for x in r.spans.split(",") if x and x.split(":")[0] in BASE] == want
        assert r.n_card == sum(x.startswith("card") for x in want)
    added = {r.doc_id: [x.kind for x in r.extra] for r in find_pii(d).collect()}
    n = len(texts)
    assert [added[n - 4], added[n - 3], added[n - 2], added[n - 1]] == [["iban"], [], ["id"], []]


def test_long_runs_stay_quick(spark):
    texts = ["a" * 200_000 + "@", "1" * 200_000, "1." * 100_000, "1 " * 100_000, "a@" + "b." * 100_000, "+" + "1)" * 100_000, "A1" * 100_000, "DE89" * 50_000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.time()
    assert find_pii(d).count() == len(texts)
    find_pii(d).selectExpr("sum(size(base))").collect()
    assert time.time() - began < 60


def announced(text, start, end, context):
    """A context word, whole and with no letter beside it, in the 40 characters on either side; the words of the whole text are looked at, one by one."""
    for m in re.finditer(rf"(?i)(?=((?:{context})s?))", text):
        for low, high in {(m.start(), m.start() + n) for n in range(1, len(m[1]) + 1) if re.fullmatch(rf"(?i)(?:{context})s?", text[m.start() : m.start() + n])}:
            whole = not (low and text[low - 1].isalpha() and low != end) and not (high < len(text) and text[high].isalpha() and high != start)
            if whole and (start - 40 <= low and high <= start or end <= low and high <= end + 40):
                return True
    return False


def test_context_on_both_sides_and_its_edges(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    cases = [
        ("The ideal part 123-45-6789", []), (f"tokenization {key}", []), ("078-05-1120 (SSN)", ["id"]), ("078-05-1120 ideal", []), ("078-05-1120", []), ("ssn 078-05-1120", ["id"]), ("ids: 078-05-1120", ["id"]),
        (f"{key} is the token", ["secret"]), (f"{key} is a tokenizer", []), ("valid" + " " * 38 + "078-05-1120", []), ("val id" + " " * 38 + "078-05-1120", ["id"]), ("x id" + " " * 39 + "078-05-1120", []),
        ("078-05-1120" + " " * 38 + "id", ["id"]), ("078-05-1120" + " " * 38 + "idle", []), ("078-05-1120" + " " * 39 + "id", []), ("Ärid 078-05-1120", []), ("078-05-1120 219-09-9999 id", ["id", "id"]), (f"token={key}", ["secret"]), (f"access_token {key}", ["secret"]),
    ]
    found = {r.doc_id: [x.kind for x in r.extra] for r in find_pii(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()}
    for i, (t, want) in enumerate(cases):
        assert found[i] == want, t


def test_several_ids_after_one_context_word(spark):
    far = "SSN: 078-05-1120" + " " * 40 + "219-09-9999"  # beyond the word's reach
    texts = ["SSN: 078-05-1120, 219-09-9999", "SSN: 078-05-1120, 219-09-9999, 457-55-5462, 987-65-4321", far, "iban 078-05-1120", "078-05-1120, ssn 219-09-9999"]
    many = "078-05-1120 x " * 300 + "ssn 219-09-9999 219-09-9998 " + "078-05-1120 x " * 300
    texts += [many, "ssn " + "078-05-1120 " * 600, "ab " * 200 + "078-05-1120 id " * 600]
    for r in find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        t = texts[r.doc_id]
        want = [m.span() for m in re.finditer(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", t) if announced(t, *m.span(), "ssn|social|security|id|insurance")]
        assert [(x.start, x.end) for x in r.extra if x.kind == "id"] == want, t[:60]
    assert len(texts) == 8


def test_empty_table(spark):
    assert find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_account_numbers_end_at_their_length(spark):
    de, gb, no = "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NO93 8601 1117 947"
    cases = [(f"IBAN {de} AND MORE", [de]), (f"IBAN {de.replace(' ', '')} PLEASE PAY", [de.replace(" ", "")]), (f"{de} {gb} {no} X", [de, gb, no]), (f"{no.replace(' ', '')}A", []), (f"x{de}", []), ("DE89 3704 0044 0532 0130 01", [])]
    found = {r.doc_id: r for r in find_pii(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()}
    for i, (t, want) in enumerate(cases):
        assert [t[x.start : x.end] for x in found[i].extra if x.kind == "iban"] == want, t


def test_secrets_need_a_word_before_them(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    cases = [(f'token = "{key}" x', [key]), (f"see {key}", []), (f"TOKEN = '{key.upper()}'", [key.upper()]), ("token abcdefghijklmnopqrstuvw", []), (f"token {'x' * 50} {key}", []), ("token " + "a1" * 100_000, ["a1" * 100_000])]
    found = {r.doc_id: r for r in find_pii(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()}
    for i, (t, want) in enumerate(cases):
        assert [t[x.start : x.end] for x in found[i].extra if x.kind == "secret"] == want, t[:60]
