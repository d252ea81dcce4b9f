"""Personal data and secrets against plain regular expressions."""

import re

import pytest
from helpers import digest_of, no_docs, odd_docs, personal, secret, some_texts

from kgspark.llm import pii, secrets

PERSONAL = ["a@b.c", "..", "@", "1", "23", "255", ".", "-", " ", "+1 ", "(017) ", "555-7713", "4111111111111111", "4111 1111 1111 1111", "x", "é", "+", "192.168.0.1", "_", "%", "\n", "😀", "000", "https://a.b/"]
SECRET = ["token", "TOKEN", "pass", "word", "wd", "api", "_", "key", "secret", '"', "'", " ", ":", "=", "abc", "DEF123", "AKIA", "ABCDEFGHIJKLMNOPQRST", "0123456789abcdef", "é", "😀", "\n", "ghp_" + "a" * 36]


@pytest.mark.parametrize(("module", "parts", "model"), [(pii, PERSONAL, personal), (secrets, SECRET, secret)])
def test_base_spans(spark, module, parts, model):
    texts = [*some_texts(11, 800, parts), "", None, "1 " * 12_000, "a." * 9_000 + "@x.y", "9" * 30_000, "token " * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in module.digest_columns(module.with_spans(docs)).collect()}
    for i, text in enumerate(texts):
        want = model(text or "")
        assert found[i].base_sha256 == digest_of(want), text
        got = [x.split(":") for x in found[i].spans.split(",") if x]
        assert {(k, int(a), int(b)) for k, a, b in got} >= {(k, a, b) for a, _, b, k in want}


@pytest.mark.parametrize("module", [pii, secrets])
def test_odd_tables(spark, module):
    docs = odd_docs(spark)
    found = module.digest_columns(module.with_spans(docs)).collect()
    assert len(found) == docs.count()
    text = {i: t or "" for i, t in docs.select("doc_id", "text").collect()}
    model = personal if module is pii else secret
    assert all(r.base_sha256 == digest_of(model(text[r.doc_id])) for r in found if r.doc_id is not None)
    assert module.with_spans(no_docs(spark)).count() == 0


def test_contexts_find_identifiers_of_unseen_form(spark):
    seeds = [(i, f"notes here and mobile number: +1 (201) 555-{1000 + i} thanks") for i in range(8)]
    copies = [(100 + i, "random words stand +1 (999) 555-0000 here") for i in range(20)]  # one instance, however often
    unseen = [(200, "write to mobile number: 0201-555-7788, please"), (201, "words stand 12345678 here"), (202, "some number 0201-555-7788 alone")]
    rows = pii.with_spans(spark.createDataFrame(seeds + copies + unseen, "doc_id long, text string").repartition(3)).collect()
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in rows}
    at = unseen[0][1].index("0201")
    assert found[200] == [("like_phone", at, at + len("0201-555-7788"))]
    assert not found[201] and not any(found[i] for i, _ in seeds)


def found_in(spark, texts: list[str]) -> list[list[tuple[str, str]]]:
    rows = pii.with_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()
    return [[(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.found] for r in sorted(rows, key=lambda r: r.doc_id)]


def test_slots_hold_the_forms_of_their_kind(spark):
    mails = ["anna(at)mail.example", "anna.k@localhost", "hein.19@mail5", "otto [at] mail [dot] example", "jo at mail dot example"]
    numbers = ["(030) 555 1234", "0201 555 778", "0201-555-7788", "0201.555.778"]
    texts = [f"please write to: user{i}@mail.example today" for i in range(20)] + [f"my mobile number: +1 (201) 555-{1000 + i} thanks" for i in range(20)]
    n = len(texts)
    texts += [f"please write to: {x}, thanks" for x in mails] + [f"my mobile number: {x}, thanks" for x in numbers] + [f"nothing before {x}" for x in mails + numbers]
    found = found_in(spark, texts)
    assert found[n : n + len(mails)] == [[("like_email", x)] for x in mails]
    assert found[n + len(mails) : n + len(mails + numbers)] == [[("like_phone", x)] for x in numbers]
    assert not any(found[:n] + found[n + len(mails + numbers) :])


def test_found_identifiers_bring_in_patterns(spark):
    local = [f"0201-555-77{k}" for k in (88, 99, 10, 11, 12)]
    texts = [f"my mobile number: +1 (201) 555-{1000 + i} thanks" for i in range(20)] + [f"my mobile number: {x} thanks" for x in local]
    texts += [f"please reach me under {x} soon" for x in (*local, "0301-555-1111")] * 2 + [f"or text {x} soon" for x in ("0201-555-7788", "0201-555-7799", "9201-555-7700", "7301-555-1111", "6301-555-1111")]
    found = found_in(spark, texts)
    assert found[20:37] == [[("like_phone", x)] for x in (*local, *(*local, "0301-555-1111") * 2)]
    assert not any(found[:20] + found[37:])  # two believed instances of five bring in nothing


def evaluate(query, text: str) -> bool:
    if query is None or isinstance(query, str):
        return query is None or query in text.lower()
    return (all if query[0] == "and" else any)(evaluate(q, text) for q in query[1])


def test_queries_never_miss_a_match():
    for rule in secrets.BASE + secrets.ADDED:
        query = secrets.trigram_query(rule.pattern)
        for text in some_texts(13, 500, [*SECRET, "-----BEGIN RSA PRIVATE KEY-----", "https://a.b:secret@c.d", "xoxb-1234567890ab"]):
            if re.search(rule.pattern, text):
                assert evaluate(query, text), (rule.kind, text)
    assert secrets.trigram_query("[0-9a-f]+") is None and secrets.trigram_query("ab?c") is None
    assert secrets.trigram_query("abcd") == ("and", ("abc", "bcd"))
    assert secrets.trigram_query("x(?:abc|def)+[0-9]") == ("or", ("abc", "def")) or evaluate(secrets.trigram_query("x(?:abc|def)+[0-9]"), "xabc1")


def test_masking(spark):
    docs = odd_docs(spark)
    out = secrets.masked(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    text = {r.doc_id: r.text for r in out.collect()}
    assert text[8] == "[SECRET] [SECRET]" and text[2] is None and text[1].startswith("alpha")
