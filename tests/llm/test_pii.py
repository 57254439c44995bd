import hashlib
import random
import re
import time

from strata.llm.pii import KINDS, base_spans, candidates, mask_spans, personal_spans, span_digests

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0


def plain(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return sorted(out + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15])


def test_base_spans_equal_plain_patterns():
    r = random.Random(3)
    parts = ["a", "b.", "@", "x@y.z", "1", "12", ".", "-", " ", "+", "(", ") ", "é", "4539 1488 0343 6467", "192.168.0.1", "300.1.1.1", "+1 (017) 555-7713", "0000255.1.2.3", "\n", "%", "4111111111111111", "٣"]
    for _ in range(20000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert base_spans(text) == plain(text), repr(text)


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("a" * 200000 + "@", "1" * 200000, "a@" * 100000, "1." * 100000, "+1" * 100000, "@a." * 100000):
        list(candidates(text, base_spans(text)))
    assert time.time() - began < 20


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    known = [(i, f"please mail me: user{i}@host.org thanks") for i in range(30)]
    unseen = [(100, "please mail me: user77#internal thanks"), (101, "the year 1999ad was fine")]
    odd = [(200, None), (201, ""), (None, "card 4111111111111111"), (0, known[0][1])]
    docs = spark.createDataFrame([(*r, "x") for r in known + unseen + odd], "doc_id long, text string, spans string")
    got = {}
    for r in span_digests(personal_spans(docs)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert got[100][0].spans == "found:16:31" and got[100][0].n_email == 0 and got[101][0].spans == ""
    assert got[200][0].base_sha256 == got[201][0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None][0].spans == "card:5:21" and len(got[0]) == 2
    for i, text in known:
        want = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in plain(text))
        assert got[i][0].spans == want and got[i][0].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert span_digests(personal_spans(docs.limit(0))).count() == 0
    assert mask_spans(docs.where("doc_id is null")).first().masked == "card [card]"


def test_counts_are_by_kind(spark):
    """Spans stand in another order than the kinds, and a kind more than once."""
    texts = ["+1 (017) 555-7713, 192.168.0.1, b@c.de", "a@b.cd x@y.zz f@g.hi", "192.168.0.1 a@b.cd", "4111111111111111", "+1 (017) 555-7713 +1 (017) 555-7714"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in span_digests(personal_spans(docs)).collect()}
    for i, text in enumerate(texts):
        spans = plain(text)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(kind == k for _, kind, _ in spans) for k in range(4)], text


def test_long_chains_of_patterns_are_followed(spark):
    from strata.llm.pii import confident_patterns

    rows = [("p0", f"seed{k}", True) for k in range(40)]
    for step in range(8):  # each pattern vouches for the instances of the next one
        rows += [(f"p{step}", f"v{step}-{k}", False) for k in range(8)] + [(f"p{step + 1}", f"v{step}-{k}", False) for k in range(8)]
        rows += [(f"p{step + 1}", f"seed{step}-{k}", True) for k in range(6)]
    good = confident_patterns(spark.createDataFrame(rows, "pattern string, value string, known boolean"), 3, 0.5, 10)
    assert {r.pattern for r in good.collect()} == {f"p{k}" for k in range(9)}


def test_grouped_numbers_and_quoted_keys(spark):
    known = [(i, f"call the phone: +1 (017) 555-77{i}") for i in range(10, 40)] + [(100 + i, f'row "fax": "+1 (018) 555-77{i}" end') for i in range(10, 40)]
    unseen = ["phone: (017) 555-7713", "phone: 017 555 7713", 'row "fax": "018 555 7713" end']
    docs = spark.createDataFrame([*known, *((1000 + k, t) for k, t in enumerate(unseen))], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in span_digests(personal_spans(docs)).collect()}
    assert [got[1000 + k] for k in range(3)] == ["found:7:21", "found:7:19", "found:12:24"]
