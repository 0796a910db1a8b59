"""Base shapes against plain regular expressions; contexts against planted ones."""

import hashlib
import random
import re

from llm_cases import empty, prose, rows, table
from quern.llm.pii import KINDS, PiiConfig, base_spans, find_personal_data, masked, op8_pii


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_shapes_on_random_strings():
    rng = random.Random(1)
    for alphabet in ("0123456789. ", "019.-+ ()", "a@b.-_%1", "4 -0", "é1.2@+ x", "٣1.+"):
        for _ in range(2500):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
            assert [(KINDS[k], a, b) for k, a, b in base_spans(text)] == brute(text), repr(text)


def test_base_shapes_take_linear_time():
    for text in ("1." * 200_000, "a@" * 200_000, "+1" * 200_000, "+1 " * 100_000 + "x", "a" * 400_000 + "@", "1 " * 200_000, "a.b@c" * 100_000):
        assert base_spans(text) is not None


CONTEXT = "patient number is {} for this"


def planted():
    rng = random.Random(8)
    data = rows(n=40)
    for i in range(12):
        email = f"user{i}@mail{i}.example.com"
        data.append((7000 + i, prose(rng, 15) + " " + CONTEXT.format(email) + " " + prose(rng, 5), "en", "a", 1))
    for i in range(10):
        data.append((7100 + i, "é\U0001f600 " + prose(rng, 9) + " " + CONTEXT.format(f"QX-{i}8841-Z") + " etc", "en", "a", 1))
    for i in range(10):  # the same shape in no trusted context
        data.append((7200 + i, f"the part list {i} shows QX-{i}8842-Z here", "en", "a", 1))
    return data


def test_contexts_find_unseen_identifiers(spark):
    data = planted()
    got = {r.doc_id: r.spans for r in find_personal_data(table(spark, data)).collect() if r.doc_id is not None}
    text = {r[0]: r[1] for r in data}
    for i in range(10):
        found = [text[7100 + i][s.start : s.end] for s in got[7100 + i] if KINDS[s.kind] == "context"]
        assert found == [f"QX-{i}8841-Z"]
        assert not [s for s in got[7200 + i] if KINDS[s.kind] == "context"]


def test_found_identifiers_lead_to_further_contexts(spark):
    """Identifiers in brackets, long ones, and ones whose context meets only found ones."""
    rng = random.Random(9)
    data = [r for r in planted() if r[0] is None or not 7100 <= r[0] < 7200]
    names = [f"QX-{i}8841-{'z' * 80 if i == 5 else 'Z'}" for i in range(10)]
    for i, name in enumerate(names):
        data.append((7300 + i, prose(rng, 9) + " " + CONTEXT.format((name, f'"{name}"', f"({name})")[i % 3]) + " etc", "en", "a", 1))
        data.append((7400 + i, prose(rng, 9) + f" zebra ledger {name} etc", "en", "a", 1))
    far = [f"RT-{i}7731-Y" for i in range(4)]
    for i, name in enumerate(far):
        data.append((7500 + i, prose(rng, 9) + f" zebra ledger {name} etc", "en", "a", 1))
    text = {r[0]: r[1] for r in data}
    got = {r.doc_id: [text[r.doc_id][s.start : s.end] for s in r.spans if KINDS[s.kind] == "context"] for r in find_personal_data(table(spark, data)).collect() if r.doc_id is not None}
    assert [got[7300 + i] for i in range(10)] == [[x] for x in names]
    assert [got[7400 + i] for i in range(10)] == [[x] for x in names]
    assert [got[7500 + i] for i in range(4)] == [[x] for x in far]
    assert not any(got[7200 + i] for i in range(10))


def test_contexts_of_any_length(spark):
    """Words and gaps before an identifier may be as long as they like."""
    rng = random.Random(10)
    word, gap = "z" * 500, " " * 300
    data = [(i, f"{prose(rng, 9)} {word}{gap}REF\n{x} etc", "en", "a", 1) for i, x in enumerate([f"u{i}@m{i}.org" for i in range(12)] + [f"QX-{i}8841-Z" for i in range(5)])]
    text = {r[0]: r[1] for r in data}
    got = {r.doc_id: [text[r.doc_id][s.start : s.end] for s in r.spans if KINDS[s.kind] == "context"] for r in find_personal_data(table(spark, data)).collect()}
    assert [got[12 + i] for i in range(5)] == [[f"QX-{i}8841-Z"] for i in range(5)]


def test_base_spans_equal_plain_search(spark):
    data = planted()
    got = find_personal_data(table(spark, data), PiiConfig(block_patterns=2)).collect()
    want = sorted(repr((r[0], brute(r[1]))) for r in data)
    assert sorted(repr((r.doc_id, [(KINDS[s.kind], s.start, s.end) for s in r.spans if s.kind < 4])) for r in got) == want


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op8_pii(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        base = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == n for k, _, _ in base) for n in KINDS[:4])
        assert r.spans.startswith(listed(base))


def test_masking():
    assert masked("call +1 or a@b.c now", [("phone", 5, 7), ("email", 11, 16), ("context", 12, 14)]) == "call [phone] or [email] now"


def test_empty_table(spark):
    assert find_personal_data(empty(spark)).count() == 0
