import math
import re
from collections import Counter

import pytest
from tillflow.llm import quality_rules as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDER = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(covered), failed)


def answers(df):
    return sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                               r.base_failed)) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_rules_and_verdicts(documents, document_rows, labels):
    judged = op.quality_rules(documents, labels).cache()
    assert answers(judged) == sorted(((i, brute(t)) for i, t in document_rows), key=str)
    rows = judged.collect()
    assert all(not r.kept for r in rows if r.base_failed)
    assert all(r.kept == (r.score >= op.THRESHOLD) for r in rows if not r.base_failed)


def test_trusted_documents_are_kept_and_most_junk_goes(documents, labels):
    judged = op.quality_rules(documents, labels).join(labels, "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.5


def test_odd_rows(odd_docs, clash, labels):
    judged = op.quality_rules(clash(odd_docs), labels)
    assert answers(judged) == sorted(((r.doc_id, brute(r.text)) for r in odd_docs.collect()), key=str)


@pytest.mark.parametrize("text", [
    "a b c a b c", "a a a a", "a b", "x y z x y z y z x", "a b c d\na b c d\n \n\nq", "l\r\nl\r\n l",
])
def test_repeats(make_docs, labels, text):
    assert answers(op.quality_rules(make_docs([text]), labels)) == [(0, brute(text))]


def test_keep_returns_whole_rows(documents, labels):
    kept = op.keep(documents, labels)
    assert kept.columns == documents.columns
    assert kept.count() == op.quality_rules(documents, labels).where("kept").count()


def test_no_labels_and_no_documents(make_docs, labels):
    assert op.quality_rules(make_docs([]), labels).collect() == []
    row = op.quality_rules(make_docs([" ".join(f"w{i}" for i in range(60))]), labels.limit(0)).first()
    assert row.kept


def test_target_counts_every_trusted_document(spark, make_docs):
    n, buckets = 20_400, 1 << 10
    docs = make_docs([(i % n if i < 2 * n else None, f"t{i % n}") for i in range(2 * n + 5)])
    trusted = spark.range(n - 200).withColumnRenamed("id", "doc_id")
    chosen = op.of_trusted(docs.selectExpr("doc_id as id", "text"), trusted.unionByName(trusted))
    assert sorted(r.id for r in chosen.collect()) == sorted(2 * list(range(n - 200)))
    # With all documents trusted the target is the raw distribution.
    everything = spark.range(n).withColumnRenamed("id", "doc_id")
    plain = docs.where("doc_id is not null")
    counted = {r.bucket: r.n for r in op._bucket_sums(plain.select("text"), buckets).collect()}
    share = {b: (c + 1) / (2 * n + buckets) for b, c in counted.items()}
    weight = op.SMOOTHING * buckets
    ratios = op.log_ratios(plain, everything, buckets=buckets)
    for b, c in counted.items():
        wanted = math.log((c + weight * share[b]) / (2 * n + weight)) - math.log(share[b])
        assert ratios[b] == pytest.approx(wanted)
