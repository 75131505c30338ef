import hashlib
import random
import re
import time

from paylens.llm import pii_spans as pii

#: The contract's patterns, applied as they stand.
PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+",
             lambda m: 13 <= len(d := re.sub("[ -]", "", m)) <= 19 and brute_luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def brute_luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    return [(kind, m.start(), m.end()) for kind, (pattern, ok) in PLAIN.items()
            for m in re.finditer(pattern, text) if ok(m[0])]


def base(text):
    return [(s.kind, s.start, s.end) for s in pii.spans_of(text) if s.kind in pii.BASE_KINDS]


EDGES = ["", "a@b.c", "x@a.b@c.d", "@a.b@c.d", "a@b.c_d@e.f", "a@b..c", "a.@b.c.", "1.2.3.4.5.6.7.8", "999.1.2.3.4",
         "000255.1.1.1", "4785380592391139", "4111 1111 1111 1111", "4111-1111 11111111 ", "+49 (30) 123-4567.",
         "+1(((", "+12+34567890123", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "é@b.c été +33 1 23 45 67 89"]


def test_base_kinds_are_the_plain_patterns():
    rng = random.Random(4)
    texts = EDGES + ["".join(rng.choice("a1@.-+ ()25é_%9\n") for _ in range(rng.randint(0, 60))) for _ in range(30000)]
    texts += ["".join(rng.choice("0123456789 -") for _ in range(40)) for _ in range(3000)]
    for text in texts:
        assert base(text) == brute(text), repr(text)


def test_further_kinds_need_checksum_or_context():
    kinds = lambda text: {s.kind for s in pii.spans_of(text)}
    assert "iban" in kinds("pay DE89 3704 0044 0532 0130 00 NOW") and "iban" in kinds("GB82WEST12345698765432")
    assert "iban" not in kinds("DE88 3704 0044 0532 0130 00")
    assert "ssn" in kinds("social security 123-45-6789") and "ssn" not in kinds("part 123-45-6789")
    assert "ssn" not in kinds("social 000-45-6789")
    near, far = (next(s for s in pii.spans_of(t) if s.kind == "ip").score for t in ("server 10.0.0.1", "10.0.0.1"))
    assert near > far >= pii.THRESHOLD


def test_work_is_linear_in_long_runs():
    begin = time.perf_counter()
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+" * 300_000, "+1" * 150_000,
                "A1" * 150_000, "@a.b" * 75_000):
        pii.spans_of(run)
    assert time.perf_counter() - begin < 20


def test_table(spark):
    rows = [(i, t, 5, "x") for i, t in enumerate([*EDGES, None, "z" * 50_000 + " a@b.c"])] + [(0, "", 5, "x"), (None, "a@b.c", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, spans string")
    got = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find(docs).collect()}
    expected = set()
    for i, text, _, _ in rows:
        spans = brute(text or "")
        counts = [sum(s[0] == k for s in spans) for k in PLAIN]
        joined = ",".join(f"{k}:{b}:{e}" for k, b, e in spans)
        expected.add((i, *counts, hashlib.sha256(joined.encode()).hexdigest()))
    assert got == expected
    hidden = pii.mask(docs)
    assert hidden.columns == docs.columns and pii.mask(docs.limit(0)).count() == 0
    by_id = {r.doc_id: r for r in hidden.collect()}
    # Other columns stay, whatever their names.
    assert by_id[1].text == "<EMAIL>" and by_id[1].n_chars == {r.doc_id: r.n_chars for r in docs.collect()}[1] and by_id[len(EDGES)].text is None
    assert by_id[len(EDGES) + 1].text.endswith("z <EMAIL>")


def test_masking_joins_overlapping_spans():
    spans = [pii.Span("phone", 2, 8, 1.0), pii.Span("card", 5, 12, 1.0), pii.Span("email", 14, 16, 1.0)]
    assert pii.masked("0123456789abcdefgh", spans) == "01<CARD>cd<EMAIL>gh"
