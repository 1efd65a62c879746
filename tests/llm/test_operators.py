"""Every operator against a plain version of itself."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from masterlint.llm import decontamination, jaccard_join, language, lines, mixing, passages, quality, sharding, token_counts, token_files
from masterlint.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def tiny(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties, and columns whose names
    the operators use themselves."""
    source = random.Random(3)
    words = ["the", "of", "Éa", "über", "x1", "42", "don't", "a_b", "naïve", "…", "日本", "##"]
    long = " ".join(source.choice(words) + str(source.randrange(500)) for _ in range(30_000))
    base = " ".join(source.choice(words) + str(i) for i in range(60))
    texts = [
        None,
        "",
        " \t\n",
        "one",
        "one two three four five",
        base,
        base,
        base + " more",
        base.upper(),
        long,
        long + " end",
        "  two  spaces\n\nand lines \r\n here ",
        "12 34 !!",
        "tab\tand\x0bvt\x0cff",
        "a▁b   c d <|endoftext|> <s>",
        "same line of at least eight words is here.\nsame line of at least eight words is here.",
    ]
    rows = [(i, t, ["en", None, "xx"][i % 3], ["s", None, "t"][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, base, None, None, None), (None, None, None, None, None), (None, "one", "en", "s", 3)]
    rows = [(*r, 1, 2, "x", True) for r in rows]
    return spark.createDataFrame(rows, SCHEMA + ", size int, component_id int, line string, score boolean")



def rows_of(df):
    return [tuple(r) for r in df.collect()]


def texts_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(params=["tiny", "odd", "empty"])
def docs(request, tiny, odd):
    return {"tiny": tiny, "odd": odd, "empty": odd.where("false")}[request.param]


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same(a, b):
    assert sorted(a, key=key) == sorted(b, key=key)


# n-gram Jaccard join


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    size = min(5, len(words)) or 1
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(docs):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        ids[root(i)].append(doc_id)
    least = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [(doc_id, len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(docs)]


def test_jaccard_components(docs):
    same(rows_of(jaccard_join.cluster(docs)), brute_components(texts_of(docs)))


def near_copies(spark, seed, n=240):
    source = random.Random(seed)
    word = lambda: "".join(source.choice("abcdef") for _ in range(3))
    passage = [word() for _ in range(30)]
    bases = [[word() for _ in range(source.choice([4, 7, 12, 40, 150, 400]))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(source.choice(bases[:3] if i % 2 else bases))
        for _ in range(source.randrange(0, 1 + len(words) // 12)):
            words[source.randrange(len(words))] = word()
        if source.random() < 0.3:
            words += passage
        rows.append((i, " ".join(words)))
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("block", [16, 4096])
def test_jaccard_near_copies_in_blocks(spark, block):
    docs = near_copies(spark, block)
    same(rows_of(jaccard_join.cluster(docs, block)), brute_components(texts_of(docs)))


def test_jaccard_near_copies_in_rows_that_come_twice(spark):
    source, rows = random.Random(11), []
    for group in range(12):
        words = [f"w{source.randrange(10**6)}" for _ in range(30)]
        rows += [(2 * group, " ".join(words)), (2 * group + 1, " ".join([*words, "more"]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    same(rows_of(jaccard_join.cluster(docs.union(docs))), brute_components(rows + rows))
    no_ids = docs.selectExpr("IF(doc_id < 4, NULL, doc_id) AS doc_id", "text")
    same(rows_of(jaccard_join.cluster(no_ids.union(no_ids))), brute_components(texts_of(no_ids) * 2))


def test_jaccard_bitmaps_of_other_nodes_stay_in_place(spark):
    kinds = "row bigint, node bigint, n bigint, keys array<bigint>, bits binary"
    nodes = spark.range(3000).selectExpr("id AS row", "id * 2 AS node", "40L AS n", "transform(sequence(1, 39), i -> xxhash64(id, i)) AS keys", "unhex(sha2(string(id), 512)) AS bits")
    nodes = jaccard_join.written(nodes.unionByName(spark.createDataFrame([(5000, 1, 40, [7, 8], bytearray(8)), (5001, 3, 41, [7, 9], bytearray(8))], kinds)), "test-nodes")
    buckets = spark.createDataFrame([(7, 2)], "key bigint, size bigint")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        found = jaccard_join._candidates(nodes, F.broadcast(buckets))
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted((r.bucket, r["size"], r.node, r.n, bytes(r.bits)) for r in found.collect()) == [(7, 2, 1, 40, bytes(8)), (7, 2, 3, 41, bytes(8))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_jaccard_keeps_one_of_each(odd):
    kept = [r.doc_id for r in jaccard_join.one_of_each(odd).collect()]
    assert jaccard_join.one_of_each(odd).columns == odd.columns
    assert 6 not in kept and 7 not in kept and 10 not in kept and {0, 1, 2, 3, 4, 9} <= set(kept)


# mixing


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        level = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if level[s] > 3 * sizes[s]]
        if not over:
            return target | level
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
            open_.discard(s)


def test_mixing_targets_and_copies(docs):
    rows = mixing.plan(docs).collect()
    given = docs.select("doc_id", "source", "text").collect()
    same([(r.doc_id, r.source, r.size) for r in rows], [(d.doc_id, d.source, len(WORD.findall(d.text or ""))) for d in given])
    sizes = defaultdict(int)
    for d in given:
        sizes[d.source] += len(WORD.findall(d.text or ""))
    targets = brute_targets(sizes) if sizes else {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        rate = r.target / r.source_size if r.source_size else 0
        assert int(rate) <= r.n_copies <= min(3, int(rate) + 1) and r.taken == r.size * r.n_copies
    taken = Counter(mixing.mix(docs).select("doc_id", "text").toPandas().itertuples(index=False, name=None)) if rows else {}
    wanted = Counter()
    for r, d in zip(sorted(rows, key=lambda r: key((r.doc_id,))), sorted(given, key=lambda d: key((d.doc_id,))), strict=True):
        if r.doc_id is not None:
            wanted[r.doc_id] += r.n_copies
    assert all(n == sum(c for (i, _), c in taken.items() if i == doc) for doc, n in wanted.items())
    if rows:
        assert mixing.mix(docs).columns == docs.columns


def test_mixing_comes_near_targets(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat('s', id % 7) AS source", "repeat('w ', CAST(1 + id % 50 AS int)) AS text")
    for r in mixing.plan(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) < 0.05 * r.target


# quality rules


def brute_quality(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    with_word = [x for x in (text or "").split("\n") if WORD.search(x)]
    n_chars = sum(map(len, words))
    return len(words), n_chars, len(re.findall(r"[#*$%&|<>]", text or "")), len(with_word), len(with_word) - len(set(with_word)), len(covered)


def test_quality_measures(docs, small):
    table = docs if docs.count() != 200 else small
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) for r in quality.ledger(table).collect()]
    same(got, [(i, *brute_quality(t)) for i, t in texts_of(table)])


def test_quality_policies_and_ablations(small):
    policy = quality.POLICIES[-1]
    ledger = quality.ledger(small).cache()
    rows = quality.decide(ledger).collect()
    for r in rows:
        assert r.kept_base == (r.n_words >= 10 and 100 * r.n_repeat_words <= 20 * r.n_words)
        assert r.kept_v1 == (r.failed & policy.mask == 0)
    for r in quality.ablations(ledger, policy).collect():
        bit = quality.BIT[r.rule]
        masks = [x.failed & policy.mask for x in rows]
        assert (r.n_failed, r.n_only_this) == (sum(m & bit != 0 for m in masks), sum(m == bit for m in masks))
        assert r.n_kept_without == sum(m & ~bit == 0 for m in masks)


# line dedup


def test_lines_equal_ones_always_go(docs):
    removed = Counter(rows_of(lines.repeated_lines(docs).select("doc_id", "line_no")))
    seen, texts = {}, sorted(texts_of(docs), key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in texts:
        for at, line in enumerate((text or "").split("\n")):
            line = line.strip(" \t\r").lower()
            if line and line in seen and seen[line] != (doc_id, at):
                assert (doc_id, at) in removed
            elif line:
                seen[line] = (doc_id, at)


def grams(line):
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def test_similar_lines_share_a_component(small):
    """Recall of the links of a brute-force comparison, and no line removed that is like no other."""
    docs = small.where("doc_id < 200")
    pairs = {(r.doc_id, r.line_no): (r.kept_doc_id, r.kept_line_no) for r in lines.repeated_lines(docs).collect()}
    table = [(d, i, x) for d, t in texts_of(docs) for i, x in enumerate(line.strip(" \t\r").lower() for line in t.split("\n")) if x]
    by_text = {}
    for d, i, x in sorted(table):
        by_text.setdefault(x, (d, i))
    distinct = [(place, grams(x)) for x, place in by_text.items()]
    index = defaultdict(set)
    for n, (_, g) in enumerate(distinct):
        for x in g:
            index[x].add(n)
    links = set()
    for n, (_, g) in enumerate(distinct):
        shared = Counter(m for x in g if len(index[x]) < 400 for m in index[x] if m < n)
        for m, _ in shared.most_common(20):
            h = distinct[m][1]
            if 100 * len(g & h) >= 80 * len(g | h):
                links.add((n, m))
    found = sum(pairs.get(distinct[n][0], distinct[n][0]) == pairs.get(distinct[m][0], distinct[m][0]) for n, m in links)
    assert links and found >= 0.95 * len(links)
    alike = {n for pair in links for n in pair}
    copies = Counter(x for _, _, x in table)
    line_at = {place: x for x, place in by_text.items()}
    for n, (place, g) in enumerate(distinct):
        if place in pairs and n not in alike and copies[line_at[place]] == 1:
            assert any(100 * len(g & h) >= 80 * len(g | h) for m, (_, h) in enumerate(distinct) if m != n)


def lines_of(spark, made):
    return spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")


@pytest.mark.parametrize(("common", "own"), [(20, 10), (15, 15)])
def test_lines_of_a_hot_band(spark, common, own):
    source = random.Random(common)
    word = lambda: "".join(source.choice("abcdefghij") for _ in range(source.randrange(3, 9)))
    opening, made = [word() for _ in range(common)], []
    for _ in range(300):
        words = [word() for _ in range(own)]
        made += [" ".join([*opening, *words]), " ".join([*opening, *words[:-1], word()])]
    sets = [grams(x) for x in made]
    wanted = {(i, j) for i in range(600) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    kept = {r.doc_id: r.kept_doc_id for r in lines.repeated_lines(lines_of(spark, made)).collect()}
    assert len(wanted) >= 290 and all(kept.get(i, i) == kept.get(j, j) for i, j in wanted)


def test_short_and_unspaced_similar_lines(spark):
    source, made = random.Random(21), []
    for length, letters in ((12, "abcdefghij"), (18, "abcdefghij "), (24, "abcdefghij "), (60, "abcdefghij"), (200, "abcdefghij")):
        for _ in range(40):
            line = "".join(source.choice(letters) for _ in range(length)).strip()
            made += [line, "z" + line if source.random() < 0.5 else line + "z"]
    sets = [grams(x) for x in made]
    wanted = [i for i in range(0, len(made), 2) if 100 * len(sets[i] & sets[i + 1]) >= 80 * len(sets[i] | sets[i + 1])]
    kept = {r.doc_id: r.kept_doc_id for r in lines.repeated_lines(lines_of(spark, made)).collect()}
    assert len(wanted) == 200 and all(kept.get(i, i) == kept.get(i + 1) for i in wanted)


def test_similar_lines_of_unlike_length(spark):
    made = ["-" * 50, "-" * 80, "come and see it " * 10, "come and see it " * 20]
    removed = rows_of(lines.repeated_lines(lines_of(spark, made)).select("doc_id", "kept_doc_id"))
    same(removed, [(1, 0), (3, 2)])


# sharding


def brute_capacity(sizes, shards):
    def needed(capacity):
        n, left = 1, capacity
        for s in sizes:
            if s > left:
                n, left = n + 1, capacity
            left -= s
        return n

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle + 1, high)
    return low


def check_shards(docs, shards):
    rows = sharding.assign(docs, shards).collect()
    given = texts_of(docs)
    same([(r.doc_id, r.size, r.text_crc32) for r in rows], [(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in given])
    load, slots, of_text = Counter(), defaultdict(list), {}
    for r in rows:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        assert of_text.setdefault((r.size, r.text_crc32), r.shard) == r.shard or r.size == 16
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return load


def test_shards(docs):
    check_shards(docs, 40)


@pytest.mark.parametrize("cells", [4, 65_536])
def test_capacity_is_the_least(spark, monkeypatch, cells):
    import hashlib

    monkeypatch.setattr(sharding, "CELLS", cells)
    monkeypatch.setattr(sharding, "FINER", 3 if cells == 4 else 64)
    source = random.Random(cells)
    texts = ["x" * source.choice([1, 5, 300, 2000]) + str(source.randrange(400)) for _ in range(900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    load = check_shards(docs, 12)
    groups = defaultdict(int)
    for t in texts:
        groups[hashlib.md5(t.encode()).hexdigest()] += len(t) + 16
    assert max(load.values()) == brute_capacity([groups[k] for k in sorted(groups)], 12)


# decontamination


def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


def test_best_passage_is_exact():
    source = random.Random(5)
    for _ in range(300):
        item = "".join(source.choice("abc") for _ in range(source.randrange(1, 70)))
        text = "".join(source.choice("abc") for _ in range(source.randrange(0, 90)))
        assert decontamination.best_passage(item, text)[0] == edit_distance_in(item, text)


def test_leaks_exact_and_edited(spark, small):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    source, wanted, rows = random.Random(7), set(), []
    texts = [t for _, t in texts_of(small)][:300]
    bench = [(r.item_id, r.text) for r in items.collect()]
    for n in range(200):
        item_id, item = bench[n % len(bench)]
        edits = decontamination.edits_allowed(len(decontamination.normal(item))) if n % 2 else 0
        copy = decontamination._edited(decontamination.normal(item), edits, source)
        words = texts[n].split(" ")
        at = source.randrange(len(words))
        rows.append((n, " ".join([*words[:at], copy, *words[at:]])))
        wanted.add((n, item_id))
    found = rows_of(decontamination.leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), items))
    assert len(wanted & {(r[0], r[1]) for r in found}) >= 0.98 * len(wanted)
    normal = {i: decontamination.normal(t) for i, t in bench}
    for doc_id, item_id, edits, start, stop in found:
        passage = decontamination.normal(dict(rows)[doc_id])[start:stop]
        assert edit_distance_in(normal[item_id], passage) == edits <= decontamination.edits_allowed(len(normal[item_id]))


def test_leaks_of_given_documents(spark, docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    bench = [(r.item_id, decontamination.normal(r.text)) for r in items.collect()]
    exact = [(i, b, 0) for i, t in texts_of(docs) for b, item in bench if item in decontamination.normal(t)]
    found = decontamination.leaks(docs, items)
    same([r[:3] for r in rows_of(found) if r[2] == 0], exact)
    dirty = Counter(i for i, _, _, _, _ in set(rows_of(found)))
    kept = decontamination.without_leaks(docs, items)
    assert kept.columns == docs.columns and not set(dirty) & {r.doc_id for r in kept.collect()}
    assert decontamination.leaks(docs, items.where("false")).count() == 0


# language


def test_languages_held_out(small):
    docs = small.withColumn("held_out", F.expr("crc32(CAST(doc_id AS string)) % 3 = 1"))
    rows = language.identify(docs, language.learn(docs.where("NOT held_out")), ["doc_id", "held_out", "lang"]).where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_languages_of_odd_texts(docs):
    rows = language.identify(docs, language.learn(docs), ["doc_id"]).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    letters = {i: any(c.isalpha() for c in t or "") for i, t in texts_of(docs) if i is not None}
    assert all((r.lang_pred == "und") != letters[r.doc_id] for r in rows if r.doc_id is not None)
    assert {r.lang_pred for r in language.identify(docs, {}, ["doc_id"]).collect()} <= {"und"}


def test_profiles_are_sums_of_bound_vectors():
    import numpy as np

    ids, counts = language.trigrams("Ab ab")
    a, b, space = (np.random.default_rng(language.SEED).choice(np.array([-1, 1], dtype=np.int8), (language.SYMBOLS, language.DIMENSIONS))[i] for i in (1, 2, 0))
    bind = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    wanted = 2 * bind(space, a, b).astype(int) + 2 * bind(a, b, space) + bind(b, space, a)
    assert (language.bundle(ids, counts) == wanted).all()


# tokens


def test_token_files_round_trip(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    folder = token_files.write_tokens(docs, tokenizer("byte_bpe_50k.json"))
    rows = token_files.read_tokens(spark, folder).orderBy("start").collect()
    wanted = Counter((i, tuple([*library.encode(t or "", add_special_tokens=False).ids, 0])) for i, t in texts_of(docs))
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == wanted
    start = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (start, len(r.ids))
        start += r.n_tokens
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert ids == sorted(ids)
    sums = {(r.start, r.ids_crc32) for r in token_files.checksums(token_files.read_tokens(spark, folder)).collect()}
    import numpy as np

    assert sums == {(r.start, zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())) for r in rows}


def test_token_files_have_the_asked_encodings(tiny, tmp_path):
    import pyarrow.parquet as pq

    folder = token_files.write_tokens(tiny, tokenizer("byte_bpe_50k.json"), f"{tmp_path}/t")
    group = pq.ParquetFile(next(iter((tmp_path / "t").glob("part-*")))).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    assert any("DICTIONARY" in e for c, v in columns.items() if c.startswith("ids") for e in v.encodings)


def test_encoder_equals_library_when_memory_starts_anew(small, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "REMEMBERED", 500)
    library = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    encoder, texts = token_files.Encoder(tokenizer("byte_bpe_50k.json")), [t for _, t in texts_of(small)][:120]
    import numpy as np

    for at in range(0, 120, 16):
        for text, ids in zip(texts[at : at + 16], encoder.encode(texts[at : at + 16]), strict=True):
            assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_encoder_tells_chunks_apart_once(monkeypatch):
    from tokenizers import Tokenizer

    library, encoder = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), token_files.Encoder(tokenizer("byte_bpe_50k.json"))
    texts = ["word", "word word, word", "word\nword\n, word", None, "", " word", "a  b\n\nc", "été 日本 x1 ;", "<|endoftext|> word", "\u00a0word", "word\tword", "a\nb c.\nd"] * 50
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: learn([learned.append(w) or w for w in words]))
    ids, bounds = encoder.ended(texts)
    wanted = [[*library.encode(t or "", add_special_tokens=False).ids, token_files.END_ID] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == wanted
    assert "word" in learned and len(learned) == len(set(learned))
    assert [x.tolist() for x in encoder.ended([])] == [[], [0]]


def test_slices_hold_every_row_in_order(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(token_files, "BYTES_AT_ONCE", 10)
    rows = list(enumerate(["", None, "x" * 30, "abc", "defghij", "k", None, "é" * 5, "y"]))
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.string())], names=["doc_id", "text"])
    found = list(token_files._slices(batch))
    assert [tuple(r.values()) for some in found for r in some.to_pylist()] == rows and len(found) == 6


def test_token_counts(docs, small):
    import sentencepiece

    table = docs if docs.count() != 200 else small
    path = tokenizer("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = rows_of(token_counts.count_tokens(table, path))
    wanted = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t in texts_of(table)]
    same(got, wanted)


def test_token_counter_equals_library_on_random_texts(monkeypatch):
    import sentencepiece

    monkeypatch.setattr(token_counts, "REMEMBERED", 60)
    path = tokenizer("piece_bpe_32k.model")
    library, counter, source = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.Counter(path), random.Random(1)
    parts = ["a", " ", "  ", "\n", "\t", "\r", "▁", "the", " the", "é", "日", "🙂", "<s>", "</s>", "<unk>", "<0x0A>", " ", ".", "//", "word" * 80]
    for _ in range(1500):
        text = "".join(source.choice(parts) for _ in range(source.randrange(0, 14)))
        assert counter.count(text) == len(library.encode(text)), repr(text)


# substring dedup


def test_units_cover_texts(docs):
    for _, text in texts_of(docs):
        at = 0
        for start, stop in passages.spans(text or ""):
            assert not text[at:start].strip() and start < stop
            at = stop
        assert not (text or "")[at:].strip()


# pipeline


def test_pipeline_keeps_labelled_short_texts(spark, small):
    import corpus_pipeline

    openings = small.where("lang IS NOT NULL").selectExpr("*", "inline(array(struct(1 AS k), struct(3 AS k), struct(8 AS k)))")
    short = openings.selectExpr("doc_id", "array_join(slice(split(trim(text), ' +'), 1, k), ' ') AS text", "lang", "source")
    short = short.where("text RLIKE '[a-zA-Z]'")
    assert corpus_pipeline.identified(spark, short, "").count() == short.count() > 1000
    blank = short.limit(2).withColumn("text", F.lit("12 !!")).unionByName(short)
    assert corpus_pipeline.identified(spark, blank, "").count() == short.count()


def test_pipeline(spark):
    import corpus_pipeline

    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = given
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == given.columns
    items = [decontamination.normal(r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    kept = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    component = {r.doc_id: r.component_id for r in jaccard_join.cluster(given).collect()}
    assert len({component[i] for i in kept}) == len(kept) and not any(i in decontamination.normal(t) for t in kept.values() for i in items)
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in out} == set(kept)
