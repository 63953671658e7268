"""What members of a star that are not linked with its hub cost, and that none is lost."""

import numpy as np
import pyarrow as pa

from gridloom.llm import ngram_join


def _star(rng, sets, hub, num, den):
    """Rows of a star's members, with lists cut as the operator cuts them."""
    rows = []
    for key, s in sets.items():
        x, y = np.setdiff1d(s, hub), np.setdiff1d(hub, s)
        most = ngram_join.most_differences(len(s), len(s) * den // num, num, den) + 1
        rows.append((key, len(s), len(x), len(y), x[:most].view(np.int64).tolist(), y[:most].view(np.int64).tolist(), True, key, 0))
    names = ["key", "n", "a", "b", "gained", "lost", "open", "own", "block"]
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(names)})
    return table.append_column("i", pa.array([0] * len(rows))).append_column("j", pa.array([0] * len(rows)))


def test_members_of_a_star_are_linked_in_proportion():
    rng = np.random.default_rng(3)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    hub, passage, core = draw(100), draw(60), draw(90)
    # copies of one text that is not the hub's, texts that only quote a passage, parts of the hub
    sets = {i: np.union1d(core, draw(4)) for i in range(60)} | {100 + i: np.union1d(passage, draw(70)) for i in range(40)} | {200 + i: hub[rng.random(100) < 0.7] for i in range(40)}
    star = _star(rng, sets, hub, 85, 100)
    found = ngram_join._siblings(85, 100, False)(star).to_pylist()
    jaccard = lambda a, b: len(np.intersect1d(a, b)) * 100 >= 85 * len(np.union1d(a, b))

    def classes(pairs):
        name = {k: k for k in sets}
        for a, b in pairs:
            x, y = name[a], name[b]
            name = {k: min(x, y) if v in (x, y) else v for k, v in name.items()}
        return name

    keys = sorted(sets)
    every = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if jaccard(sets[a], sets[b])]
    linked = [(r["hub"], r["key"]) for r in found if r["sure"] or jaccard(sets[r["hub"]], sets[r["key"]])]
    assert classes(linked) == classes(every) and len(every) > 1_500
    assert all(jaccard(sets[r["hub"]], sets[r["key"]]) for r in found if r["sure"])
    assert not [r for r in found if r["sure"] is False and r["hub"] // 100 != r["key"] // 100]
    # the first round takes not the square of the copies, nor all that share a passage
    assert len(ngram_join._siblings(85, 100, True)(star)) < len(sets)


def test_least_apart_never_exceeds_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(2))
        u, v = rng.integers(0, len(x) + 1), rng.integers(0, len(y) + 1)
        true = len(np.setxor1d(x, y))
        assert ngram_join.least_apart(x[:u], len(x), y[:v], len(y)) <= true == ngram_join.least_apart(x, len(x), y, len(y))


def test_blocks_of_a_star_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "STAR", 3)
    rng = np.random.default_rng(5)
    words = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    common, base = words(120), words(100)
    texts = [common + words(60) for _ in range(12)]
    texts += [t[:150] + words(2) + t[152:] for t in texts[:8]] + [base[:i] + words(1) + base[i:] for i in range(0, 40, 2)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.join_documents(docs).collect()}
    sets = [{tuple(t[i : i + 4]) for i in range(len(t) - 3)} for t in texts]
    want = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                x, y = want[i], want[j]
                want = [min(x, y) if w in (x, y) else w for w in want]
    assert [got[i] for i in range(len(texts))] == want and len(set(want)) < 20
