import hashlib
import re

from skytally.llm import pii
from skytally.llm.store import table
from tests.llm.helpers import ODD, documents

# The patterns of strict spans.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def fits(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def strict(text):
    found = [
        (m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "", re.ASCII) if fits(k, m.group())
    ]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


HARD = [
    "x@y.com_z@w.org a@b@c.d q@nodot .@a.b",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3 99999999999999999999999.1.1.1",
    "4539 1488 0343 6467 4539-1488-0343-6467 4539148803436467 4539148803436468 12345678901234567890123",
    "+1 (269) 555-3296 +1 +12 +44.20.7946.0958- +1(((((((( +123456789012345678",
    "+1 (269) 555-3296 4539148803436467",
    "😀 é a@b.co 😀 10.0.0.1",
    "a" * 3000 + "@" + "b." * 3000 + "c",
    "1" * 5000,
    "+" + "(" * 3000,
    "1-" * 2500,
]


def test_strict_spans_equal_the_patterns(spark, sf_dir):
    texts = [r[1] for r in ODD] + HARD + [r.text for r in table(spark, sf_dir, "documents").collect()]
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in pii.op7(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = strict(text)
        assert got[i].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), text[:80]
        spans = got[i].spans.split(",") if got[i].spans else []
        assert set(base) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), list(PATTERNS).index(s.split(":")[0])))
        for kind in PATTERNS:
            assert got[i][f"n_{kind}"] == sum(s.startswith(kind + ":") for s in spans)


def test_the_method_adds_what_strict_patterns_miss(spark):
    """A phone beside a card is one match of the strict pattern for phones, and fails."""
    plain = [f"call +1 ({200 + i}) 555-{1000 + i} now" for i in range(60)] + [f"card 45391488034364{x:02d} ok" for x in range(100) if luhn(f"45391488034364{x:02d}")]
    plain += [f"total {i}{i + 11}4{i + 5} units" for i in range(40)] + ["nothing here"] * 30
    texts = plain * 3 + ["call +1 (269) 555-3296 4539148803436467 now", "number 4539148803436468 fails"]
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in pii.op7(docs).collect()}
    odd = got[len(texts) - 2]
    assert odd.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert odd.spans == "phone:5:22,card:23:39"
    assert got[len(texts) - 1].spans == ""
    assert all(got[i].spans == "" for i, t in enumerate(texts) if t.startswith(("total", "nothing")))


def test_counts_are_of_strict_spans_also_where_others_are_added(spark):
    """Phones that run into a card number are found by the wider patterns only, and counted nowhere."""
    texts = [f"call +1 ({200 + i}) 555-{1000 + i} now" for i in range(60)] + [f"card 45391488034364{x:02d} ok" for x in range(100)]
    texts += [f"total {i}{i + 11}4{i + 5} units" for i in range(40)]
    texts = texts * 3 + ["call +1 (269) 555-3296 4539148803436467 now, write a@b.co"]
    docs = documents(spark, [(i, t, "en", "a", 1) for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in pii.op7(docs).collect()}
    assert got[len(texts) - 1].spans == "phone:5:22,card:23:39,email:51:57"
    for i, text in enumerate(texts):
        base = strict(text)
        assert [got[i][f"n_{kind}"] for kind in PATTERNS] == [sum(s.startswith(kind + ":") for s in base) for kind in PATTERNS]


def test_redaction(spark):
    docs = documents(spark)
    clean = pii.redacted(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert "<EMAIL>" in texts[11] and "<IP>" in texts[11] and "a.b@c.org" not in texts[11] and "10.0.0.1" not in texts[11]
    assert texts[11].endswith("new ünicode 😀 line") and texts[1] is None and texts[2] == ""
    assert texts[9] == ODD[10][1]
    again = pii.op7(clean).collect()
    assert all(r.n_email == 0 for r in again)


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert pii.op7(docs).count() == 0 and pii.redacted(docs).count() == 0
