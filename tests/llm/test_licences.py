import re

from tillflow.llm import licences as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def check(df, rows):
    found = sorted(((r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
                    for r in df.collect()), key=str)
    assert found == sorted(((i, brute(t)) for i, t in rows), key=str)


def test_all_documents(documents, document_rows):
    found = op.scan(documents).cache()
    check(found, document_rows)
    for r in found.collect():
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_templates_are_found_where_they_stand(make_docs):
    mit = "x y Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and " \
          "associated documentation files (the \"Software\"), to deal in the Software without restriction, including " \
          "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell " \
          "copies of the Software"
    docs = make_docs([mit, "Licensed under CC BY-NC 4.0.", "permission is granted to any person", "plain words"])
    found = {r.doc_id: r for r in op.scan(docs).collect()}
    assert found[0].labels == "mit" and found[0].matches[0].first_word == 2 and found[0].score == 1.0
    assert found[1].labels == "cc-by-nc" and found[1].base_labels == ""
    assert found[2].labels == "" and found[2].score < 1
    assert found[3].labels == "" and found[3].score == 0


def test_odd_rows(make_docs, clash):
    rows = [(1, None), (2, ""), (3, "MIT License"), (3, "MIT License"), (None, "mit licensé mit license"),
            (4, "mit license " * 5000), (5, "general public general public license"), (6, "\U0001f600mit license"),
            (7, "apache\nLICENSE-apache license")]
    check(op.scan(clash(make_docs(rows))), rows)
    assert op.scan(make_docs([])).collect() == []
