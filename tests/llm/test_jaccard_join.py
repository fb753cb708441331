import random
import re

import numpy as np
import pytest
from tillflow.llm import jaccard_join as op
from tillflow.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(rows, width=4, percent=85):
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min((x for x in (least.get(root(k)), i) if x is not None), default=None)
    return sorted(((i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)), key=str)


def answers(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def near_copies(seed, groups=6, copies=25):
    """Groups of edited copies, some just inside the limit and some just outside."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 120))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rnd.randint(0, 4)):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                words += [rnd.choice(vocabulary) for _ in range(rnd.randint(1, 8))]
            rows.append(" ".join(words))
    line = " ".join(vocabulary[:12])
    rows += [line + " " + " ".join(rnd.choice(vocabulary) for _ in range(20)) for _ in range(40)]
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("region_shingles", [4_000_000, 600])
def test_edited_copies_in_tasks_and_across_the_cluster(make_docs, monkeypatch, region_shingles):
    monkeypatch.setattr(op, "LEAF", 4)
    monkeypatch.setattr(op, "PIVOTS", 3)
    rows = near_copies(region_shingles)
    assert answers(op.jaccard_join(make_docs(rows), region_shingles=region_shingles)) == brute(rows)


def test_given_documents_at_other_settings(documents, document_rows):
    assert answers(op.jaccard_join(documents, width=5, percent=80)) == brute(document_rows, 5, 80)


def test_odd_rows(odd_docs, clash):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert answers(op.jaccard_join(clash(odd_docs))) == brute(rows)
    assert op.jaccard_join(odd_docs.limit(0)).collect() == []


def test_keep_leaves_one_of_each_group(make_docs):
    rows = near_copies(5, groups=2, copies=10)
    docs = make_docs(rows)
    kept = op.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})


@pytest.mark.parametrize("seed", range(4))
def test_region_recursion_is_exact(monkeypatch, seed):
    monkeypatch.setattr(op, "LEAF", 3)
    monkeypatch.setattr(op, "PIVOTS", 2)
    rows = near_copies(seed, groups=3, copies=12)
    region = op.Region(op.shingle_sets([t.encode() for _, t in rows], 4), op.Rule())
    region.join(np.arange(len(rows)))
    wanted = brute(rows)
    component = {i: c for i, _, c in wanted}
    groups = {}
    for i, _ in rows:
        groups.setdefault(region.root(i), []).append(i)
    assert sorted(map(sorted, groups.values())) == sorted(
        sorted(i for i in component if component[i] == c) for c in set(component.values()))


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (10, 11), (11, 12), (12, 13), (13, 14), (14, 10), (3, 20)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.vertex, r.component) for r in found} == {
        *((v, 1) for v in (1, 2, 3, 20)), (4, 4), (5, 4), *((v, 10) for v in range(10, 15))}


def texts_apart(n, words=30):
    return [" ".join(f"t{i}x{k}" for k in range(words)) for i in range(n)]


def test_null_ids_and_shared_ids_keep_all_unlike_texts(make_docs):
    a, b, c, d, e, f = texts_apart(6)
    near = c + " more"
    rows = [(None, a), (None, b), (None, b), (None, c), (None, near), (7, d), (7, e), (None, ""), (None, " "),
            (9, f), (None, f + " more")]
    kept = sorted((r.doc_id, r.text) for r in op.keep(make_docs(rows)).collect() if r.doc_id is not None)
    assert kept == sorted([(7, d), (7, e), (9, f)])
    nameless = [r.text for r in op.keep(make_docs(rows)).collect() if r.doc_id is None]
    assert len(nameless) == 5 and {a, b, "", " "} < set(nameless)
    assert len({c, near} & set(nameless)) == 1


def test_class_without_an_id_bridges_others(make_docs):
    words = [f"b{k}" for k in range(100)]
    rows = [(3, " ".join(words)), (None, " ".join([*words, *(f"m{k}" for k in range(12))])),
            (5, " ".join([*words, *(f"m{k}" for k in range(24))]))]
    assert brute(rows)[0][2] == brute(rows)[1][2] == brute(rows)[2][2] == 3
    assert answers(op.jaccard_join(make_docs(rows))) == brute(rows)


@pytest.mark.parametrize("block", [16, 1024])
def test_large_regions_of_strangers_need_no_round_over_the_cluster(make_docs, monkeypatch, block):
    """Texts of which any two have 80 % in common: no pivot tells them apart."""
    monkeypatch.setattr(op, "BLOCK", block, raising=False)
    rounds, measure = [], op.measure_pivots
    monkeypatch.setattr(op, "measure_pivots", lambda *a: rounds.append(1) or measure(*a))
    line = " ".join(f"v{k}" for k in range(11))
    rows = [(i, f"{line} only{i}") for i in range(200)] + [(500 + i, t) for i, t in near_copies(7, 1, 8)[:8]]
    assert answers(op.jaccard_join(make_docs(rows), region_shingles=600)) == brute(rows)
    assert not rounds


def test_strangers_that_meet_in_a_large_region_are_parted_by_their_profiles(make_docs, monkeypatch):
    """As the pipeline joins them: a smaller text meets every larger one in a common n-gram, and
    no two of them have 80 % in common, apart from one near copy."""
    monkeypatch.setattr(op, "BLOCK", 16, raising=False)
    cut, rounds, measure = [], [], op.measure_pivots
    monkeypatch.setattr(op, "measure_pivots", lambda *a: rounds.append(1) or measure(*a))
    if hasattr(op, "groups_of_large"):
        part = op.groups_of_large
        monkeypatch.setattr(op, "groups_of_large", lambda *a: cut.append(a[0].count()) or part(*a))
    line = " ".join(f"v{k}" for k in range(31))
    rows = [(i, f"{line} " + " ".join(f"only{i}x{k}" for k in range(5))) for i in range(1, 200)]
    rows += [(0, f"{line} a b c"), (300, rows[4][1] + " more")]
    kept = op.keep(make_docs(rows), width=5, percent=80, region_shingles=600)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute(rows, 5, 80)}) == list(range(200))
    assert not rounds and max(cut) > 190


def test_ngrams_that_are_frequent_in_no_task_are_put_last(spark):
    line = "a line that stands in the text of every single task"
    rows = [(i, f"{line} " + " ".join(f"w{i}x{k}" for k in range(9))) for i in range(40)]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 40), "doc_id long, text string")
    levels = op.cell_levels(op.describe(op._texts(docs, "doc_id", "text"), op.Rule()))
    shared = op.shingle_sets([line.encode()], 4)[0] >> np.uint64(64 - op.CELL_BITS)
    assert (levels[shared.astype(int)] > 0).all()


def overlapping_sets(seed, n=150):
    """Sets of single words, many of them just inside or outside the limit."""
    rnd = random.Random(seed)
    bases = [[f"w{rnd.randrange(60)}" for _ in range(rnd.randint(8, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = list(dict.fromkeys(rnd.choice(bases)))
        for _ in range(rnd.randint(0, 4)):
            if rnd.random() < 0.6:
                words.pop(rnd.randrange(len(words)))
            if rnd.random() < 0.6:
                words.append(f"w{rnd.randrange(60)}")
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("percent", [60, 75, 85])
def test_sizes_and_places_leave_no_link_out(make_docs, monkeypatch, percent):
    monkeypatch.setattr(op, "BLOCK", 8, raising=False)
    rows = overlapping_sets(percent)
    wanted = brute(rows, 1, percent)
    for most in (200, 4_000_000):
        assert answers(op.jaccard_join(make_docs(rows), width=1, percent=percent, region_shingles=most)) == wanted


def test_profiles_part_no_linked_members():
    rule = op.Rule()
    sets = sorted(op.shingle_sets([t.encode() for _, t in near_copies(3)], 4), key=len)
    n = np.array([len(s) for s in sets])
    profile = np.frombuffer(b"".join(map(op.profile_of, sets)), np.uint8).reshape(len(n), -1)
    group = op.near_groups(n, profile, rule)
    for a, s in enumerate(sets):
        common = np.array([len(np.intersect1d(s, t)) for t in sets])
        assert (group[rule.linked(common, n + n[a])] == group[a]).all()
    assert len(set(group.tolist())) > 6
