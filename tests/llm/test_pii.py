import hashlib
import math
import re
import time
from collections import Counter

import regex
from pyspark.sql import functions as F
from tillflow.llm import pii as op

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for k, v in enumerate(values)) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
            "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
            "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        spans += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if passes(kind, m[0])]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))


def answers(df):
    rows = df.select("doc_id", op.spelled(F.col("base")).alias("base")).collect()
    return sorted(((r.doc_id, r.base) for r in rows), key=str)


def test_all_documents(documents, document_rows):
    found = answers(op.sanitise(documents))
    assert found == sorted(((i, brute(t)) for i, t in document_rows), key=str)
    assert any(base for _, base in found)


TEXTS = [
    "a@b.c_d@e.f x@y x@y.z. é\U0001f600 me@host.example.org", "@a.b a@.b a@b..c a@b.c@d.e",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.1.1.0255 01.002.3.4 1.2.3.99999999999999999999", "1.2.3", "...1.2.3.4...",
    "4111 1111 1111 1111", "4111-1111-1111-1112 4111111111111111", "0 0 0 0 0 0 0 0 0 0 0 0", "12345",
    "+1 (988) 555-2485 +49 30 1234567890123 +12345678 +1--------2 +1 (", "++1 234 567 890", "+1.2.3.4 567 890",
    "call +1 (555) 123-4567 or mail bob@x.org from 10.0.0.1 with 5500 0000 0000 0004",
]


def test_patterns(make_docs):
    assert answers(op.sanitise(make_docs(TEXTS))) == sorted(
        ((i, brute(t)) for i, t in enumerate(TEXTS)), key=str)


def test_very_long_runs(make_docs):
    """Runs on which the patterns as written would look again from every place."""
    wanted = {"a" * 80_000: "", "1" * 60_000: "", "1 " * 30_000: "", "+1" + "2" * 30_000: "",
              "a." * 20_000 + "@" + "b." * 20_000 + "c": "email:0:80002"}
    assert answers(op.sanitise(make_docs(list(wanted)))) == list(enumerate(wanted.values()))


def test_odd_rows(odd_docs, clash):
    assert answers(op.sanitise(clash(odd_docs))) == sorted(((r.doc_id, brute(r.text)) for r in odd_docs.collect()), key=str)
    assert op.sanitise(odd_docs.limit(0)).collect() == []


def test_terms_that_stand_only_with_an_entity_are_disclosing(make_docs):
    rows = [f"word{i} ask for zeppelin Quux at boss@corp.example.com please word{i}" for i in range(5)]
    rows += [f"please ask for more words number{i} at home" for i in range(60)]
    found = op.sanitise(make_docs(rows)).orderBy("doc_id").collect()
    for r in found[:5]:
        assert {t.term for t in r.terms} == {"zeppelin", "quux"}
        assert all(rows[r.doc_id][t.start:t.end].lower() == t.term for t in r.terms)
        assert all(t.action == "remove" for t in r.terms)
    assert all(not r.terms for r in found[5:])


def test_redacted_text(spark):
    row = spark.sql("select 'ab1234cd56' as t, array(struct(2 as start, 6 as end, '#' as mark), "
                    "struct(8 as start, 10 as end, '' as mark)) as s")
    assert row.select(op.redacted(F.col("t"), F.col("s")).alias("x")).first().x == "ab#cd"


def test_digest_of_no_span():
    assert hashlib.sha256(brute("nothing").encode()).hexdigest().startswith("e3b0c442")


def test_terms_of_rare_entities_far_from_them(make_docs):
    filler = "these are the same common words of every text"
    rows = [f"Bo said {filler} {filler} {filler} write to bo.x@corp.example.com BO" for _ in range(2)]
    rows += [f"Wyzzek Bo2 {filler} {filler} mail w@one.example.org"]
    rows += [f"said write to mail {filler} example com corp org" for _ in range(400)]
    found = op.sanitise(make_docs(rows)).orderBy("doc_id").collect()
    for r in found[:2]:
        assert [(rows[r.doc_id][t.start:t.end], t.term, t.action) for t in r.terms] == [
            ("Bo", "bo", "generalise"), ("BO", "bo", "generalise")]
    assert [(rows[2][t.start:t.end], t.term) for t in found[2].terms] == [("Wyzzek", "wyzzek"), ("Bo2", "bo2")]
    assert all(not r.terms for r in found[3:])


def lambdas_with_a_cut(df):
    """Lambdas of the optimized plan that cut or search a whole text."""
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction(" in plan and "split(text#" in plan
    found = []
    for start in (m.end() for m in re.finditer(r"lambdafunction\(", plan)):
        depth, stop = 1, start
        while depth:
            depth += {"(": 1, ")": -1}.get(plan[stop], 0)
            stop += 1
        if re.search(r"(split|regexp_extract_all)\(text#", plan[start:stop]):
            found.append(plan[start:stop])
    return found


def test_no_text_is_cut_inside_a_lambda(documents):
    """The optimizer folds columns into lambdas if it may: the text would be cut for every match."""
    assert lambdas_with_a_cut(op.found(documents)) == []
    located = op.located(documents.select("doc_id", "text"), "text", op.TOKEN, "words")
    assert lambdas_with_a_cut(located) == []
    assert lambdas_with_a_cut(op.each(located, F.col("words"), "w", "doc_id")) == []


def test_texts_of_many_matches(make_docs):
    """Twenty thousand addresses, and as many marked words, in one text."""
    mails = " ".join(f"user{i}@host{i % 7}.example" for i in range(20_000))
    words = " ".join(f"zq{i}w" for i in range(20_000)) + " mail one@two.example"
    rows = [mails, words, *[f"nothing of note {i % 5}" for i in range(300)]]
    begun = time.time()
    found = {r.doc_id: r for r in op.sanitise(make_docs(rows)).collect()}
    assert time.time() - begun < 60
    assert op_spelled(found[0].base) == brute(mails) and op_spelled(found[1].base) == brute(words)
    assert {words[t.start:t.end] for t in found[1].terms} >= {f"zq{i}w" for i in range(20_000)}
    assert all(mails[t.start:t.end].lower() == t.term for t in found[0].terms)


def op_spelled(spans):
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def test_repeated_rows_count_once(make_docs):
    rows = [(i, f"word{i} ask for zeppelin Quux at boss@corp.example.com please word{i}") for i in range(5)]
    rows += [(100 + i, f"please ask for more words number{i} at home") for i in range(60)]
    seen = []
    for copies in (0, 1, 3):
        found = op.sanitise(make_docs(rows + rows[:5] * copies + rows[7:9] * copies)).collect()
        assert len(found) == len(rows) + 7 * copies
        seen.append({(r.doc_id, tuple(r.terms)) for r in found})
    assert seen[0] == seen[1] == seen[2]
    assert {t.term for _, terms in seen[0] for t in terms} == {"zeppelin", "quux"}


def brute_terms(rows, prior=op.PRIOR, low=0.7, high=0.9):
    """Places of disclosing terms by the definition, over all pairs."""
    distinct = sorted(set(rows), key=str)
    words = {r: {w.lower() for w in regex.findall(op.TOKEN, r[1] or "")} for r in distinct}
    held = {r: {f"{k}:{r[1][s:e].lower()}" for k, s, e in spans_of(r[1])} for r in distinct}
    n_term = Counter(w for r in distinct for w in words[r])
    n_entity = Counter(e for r in distinct for e in held[r])
    both = Counter((e, w) for r in distinct for e in held[r] for w in words[r])
    action = {}
    for (e, w), n in both.items():
        rate = n_entity[e] / len(distinct)
        share = math.log((n + prior * rate) / (n_term[w] + prior) / rate) / -math.log(rate) if rate < 1 else 0
        if share >= low:
            action[e, w] = "remove" if share >= high else "generalise"
    found = {}
    for r in distinct:
        spans = spans_of(r[1])
        marks = {w: max(a) for w in words[r] if (a := [action[e, w] for e in held[r] if (e, w) in action])}
        found[r] = [(m.start(), m.end(), m[0].lower(), marks[m[0].lower()])
                    for m in regex.finditer(op.TOKEN, r[1] or "") if m[0].lower() in marks
                    and not any(s < m.end() and e > m.start() for _, s, e in spans)]
    return found


def spans_of(text):
    return [(k, int(s), int(e)) for k, s, e in (p.split(":") for p in brute(text).split(",") if p)]


def test_terms_equal_brute_force(documents, document_rows):
    wanted = brute_terms(document_rows)
    found = op.sanitise(documents).collect()
    assert {(r.doc_id, tuple(tuple(t) for t in r.terms)) for r in found} == {
        (i, tuple(spans)) for (i, _), spans in wanted.items()}
    assert any(wanted.values())


def test_terms_of_lists_and_overlaps(make_docs):
    rows = [(1, "ébob@x.org Élan a@b.cd e@f.gh q@r.st Ölan wan"), (2, "a@b.cd wan éb"), (3, "e@f.gh q@r.st élan"),
            (4, None), (5, ""), (None, "a@b.cd wan"), (6, "10.0.0.1 10 0 1 élan")]
    rows += [(100 + i, f"common words {i % 3} bob x org 10 {i}") for i in range(200)]
    wanted = brute_terms(rows)
    found = op.sanitise(make_docs(rows)).collect()
    assert {(r.doc_id, tuple(tuple(t) for t in r.terms)) for r in found} == {
        (i, tuple(spans)) for (i, _), spans in wanted.items()}
