import re

from tidemark.llm import decontam


def words(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        own = words(text)
        n = min(width, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            windows.setdefault(tuple(own[k : k + n]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        own = words(text)
        hit, ids = set(), set()
        for n in range(1, width + 1):
            for k in range(len(own) - n + 1):
                if found := windows.get(tuple(own[k : k + n])):
                    hit.update(range(k, k + n))
                    ids |= found
        out[doc] = (len(own), len(hit), sorted(ids))
    return out


def as_dict(df):
    return {r.doc_id: (r.n_words, sum(s.end - s.first for s in r.hit_spans), r.item_ids) for r in df.collect()}


def test_matches_brute_force_also_in_blocks(spark, table):
    docs = [(r.doc_id, r.text) for r in table("documents").collect()]
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    want = brute(docs, items)
    assert any(v[1] for v in want.values())
    assert as_dict(decontam.contamination(table("documents"), table("benchmark"))) == want
    assert as_dict(decontam.contamination(table("documents"), table("benchmark"), block_bytes=9000)) == want


def test_short_items_overlaps_and_case(spark):
    items = [(1, "Alpha beta"), (2, "gamma"), (10, "one two three four five six seven eight nine ten eleven"),
             (3, ""), (4, None), (None, "delta"), (5, "gamma")]
    text = "x ALPHA-beta gamma one two three four five six seven eight nine ten eleven alpha; beta! ünï"
    docs = [(1, text), (2, "alpha gammab"), (3, None), (4, ""), (5, "delta"), (6, "beta alpha beta"), (7, "alpha"), (8, "beta")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = as_dict(decontam.contamination(d, b))
    assert got == brute(docs, [x for x in items if x[0] is not None])
    assert got[1][2] == ["1", "10", "2", "5"]
    assert [r.doc_id for r in decontam.clean_documents(d, b).orderBy("doc_id").collect()] == [2, 3, 4, 5, 7, 8]


def test_runs_of_several_blocks_join(spark):
    text = "a1 b2 c3 d4 e5 f6"
    docs = spark.createDataFrame([(1, text), (2, text), (3, None), (4, "q"), (None, text)], "doc_id long, text string")
    items = [(i, t) for i, t in enumerate(["a1 b2", "b2 c3", "d4", "f6", "q r", "zz"])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    made = decontam.contamination(docs, bench, block_bytes=3)
    got = {r.doc_id: ([tuple(s) for s in r.hit_spans], r.item_ids, r.n_words) for r in made.collect()}
    full = ([(0, 4), (5, 6)], ["0", "1", "2", "3"], 6)
    assert got == {1: full, 2: full, None: full, 3: ([], [], 0), 4: ([], [], 1)}
    assert made.columns == decontam.contamination(docs, bench).columns


def test_odd_rows_and_empty_tables(spark, table, odd_documents, no_documents):
    rows = decontam.contamination(odd_documents, table("benchmark"), keep=["doc_id", "n_words", "lang"]).collect()
    assert len(rows) == odd_documents.count() and all(isinstance(r.n_words, int) for r in rows)
    parts = decontam.contamination(odd_documents, table("benchmark"), keep=["doc_id", "n_words", "lang"], block_bytes=12000)
    assert sorted(map(str, parts.collect())) == sorted(map(str, rows))
    clean = decontam.clean_documents(odd_documents, table("benchmark").where("false"))
    assert clean.columns == odd_documents.columns and clean.count() == odd_documents.count()
    assert decontam.contamination(no_documents, table("benchmark")).count() == 0


def test_items_without_an_id_are_searched(spark):
    docs = spark.createDataFrame([(1, "has delta in it"), (2, "gamma and delta"), (3, "none")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "Delta"), ("5", "gamma")], "item_id string, text string")
    want = {1: ([(1, 2)], []), 2: ([(0, 1), (2, 3)], ["5"]), 3: ([], [])}
    for limit in (decontam.BLOCK_BYTES, 1):
        found = decontam.contamination(docs, items, unnamed=True, block_bytes=limit).collect()
        assert {r.doc_id: ([tuple(s) for s in r.hit_spans], r.item_ids) for r in found} == want
    assert [r.doc_id for r in decontam.clean_documents(docs, items, unnamed=True).collect()] == [3]
