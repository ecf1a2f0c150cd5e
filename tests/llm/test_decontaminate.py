import re

from tallyhouse.llm.decontaminate import _shards, digest, find_contamination, keep_clean

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(t):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window=10):
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, x in items:
            x = words(x)
            k = min(window, len(x))
            for a in range(len(x) - k + 1 if k else 0):
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == x[a : a + k]:
                        hit |= set(range(p, p + k))
                        ids.add(str(i) if i is not None else "null")
        out.append((d, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


DOCS = [
    (1, "Start. One-two three, FOUR five six seven eight nine ten! eleven twelve end"), (2, None), (3, ""), (4, "short item Here"), (5, "Shört item"),
    (6, "one two three four five six seven eight nine"), (6, "short ITEM"), (None, "short item"), (7, "x " * 500 + "short item " * 3), (8, "shortitem short items"),
]
ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (2, "short item"), (3, None), (4, "..."), (5, "shört"), (None, "short, item"),
    (12, "two three four five six seven eight nine ten eleven"),
]


def test_hits_against_brute_force_with_any_number_of_automata(spark):
    docs = spark.createDataFrame([(*r, 1) for r in DOCS], "doc_id long, text string, hits int")
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], "item_id long, text string, shard string")
    for shard_chars in (1 << 20, 40):
        rows = find_contamination(docs, items, shard_chars=shard_chars).collect()
        got = sorted(((r.doc_id, r.n_words, sum(h["last"] - h["first"] + 1 for h in r.hits), list(r.item_ids)) for r in rows), key=repr)
        assert got == brute(DOCS, ITEMS)
        for r in rows:
            for h in r.hits:
                texts = [t for d, t in DOCS if d == r.doc_id and t]
                assert any(words(t.encode()[h["start"] : h["end"]].decode()) == words(t)[h["first"] : h["last"] + 1] for t in texts)
        kept = keep_clean(docs, items, shard_chars=shard_chars).collect()
        assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in rows if not r.hits)


def test_empty_sides(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert digest(find_contamination(docs, items)).filter("contaminated").count() == 0
    assert keep_clean(docs, items).count() == len(DOCS)
    assert find_contamination(docs.limit(0), items).count() == 0


def test_items_of_one_id_are_dealt_by_text_and_equal_ones_once(spark):
    items = spark.createDataFrame([(7, f"item number {i} of many") for i in range(400)] + [(7, "the same item again")] * 400, "item_id long, text string")
    shards = [s.value for s in _shards(items, 1000)]
    assert sum(map(len, shards)) == 401 and max(sum(len(t) for _, t in s) for s in shards) < 3000
