"""Edge cases of the operators on documents, against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from cases import ASCII, components, documents, empty, least, pairs, prose, shingles
from tokenizers import Tokenizer

from incidentry.llm import decontaminate, jaccard_join, language_id, license_scan, suffix_dedup
from incidentry.llm.bpe import bpe_decode, bpe_encode, bpe_round_trip, vocabulary
from incidentry.llm.jaccard_join import jaccard_components
from incidentry.llm.queries import SQL_LICENSES
from incidentry.llm.language_id import cut_windows, fit_language_id, held_out, predict_language

PATH = public_tokenizers.path("byte_bpe_50k.json")


def key(row):
    return repr(tuple(row))


def test_jaccard_join_equals_all_pairs(spark):
    docs = documents(spark)
    rows = pairs(docs)
    sets = [shingles(t) for _, t in rows]
    label = components(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 80 * len(a | b))
    want = [
        (d, len(s), least(rows[k][0] for k in range(len(rows)) if label[k] == label[i]) if s else d)
        for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))
    ]
    got = [tuple(r) for r in jaccard_components(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_jaccard_join_near_copies_of_one_text(spark):
    """Many different near copies: those below the limit with the centre still find each other."""
    rng, words = random.Random(4), prose(150, 9).split(" ")
    texts = []
    for i in range(60):
        copy = list(words)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = f"w{rng.randrange(1000)}"
        texts.append((i, " ".join(copy)))
    sets = [shingles(t) for _, t in texts]
    label = components(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b))
    want = {i: min(k for k in range(60) if label[k] == label[i]) for i in range(60)}
    got = jaccard_components(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    assert {r["id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("words", range(7))
def test_shingles_of_a_piece_with_few_words(words):
    text = np.frombuffer(b" ".join(b"w%d" % i for i in range(words)), np.uint8)
    values, bounds, _ = jaccard_join.shingle_sets(text, np.array([0, len(text)]))
    beside = np.concatenate([text, np.frombuffer(b" some more words of another row", np.uint8)])
    both, of, _ = jaccard_join.shingle_sets(beside, np.array([0, len(text), len(beside)]))
    assert len(values) == bounds[1] == (max(words - 4, 1) if words else 0)
    assert values.tolist() == both[: of[1]].tolist()


@pytest.mark.parametrize(("held", "common", "gathered"), [(10**9, 10**9, 1000), (40, 6, 7), (5, 2, 300)])
def test_common_shingles_are_sent_on_with_one_count(monkeypatch, held, common, gathered):
    """Every posting of a shared shingle once or more, and one df for each shingle, however little is held."""
    monkeypatch.setattr(jaccard_join, "HELD", held)
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    rng = np.random.default_rng(held % 97)
    hashes = rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    sets = {}
    for node in range(60):
        some = rng.choice(40, rng.integers(1, 25), replace=False, p=np.r_[np.full(4, 0.15), np.full(36, 0.4 / 36)])
        sets[node] = np.sort(hashes[some])
    sets[60] = np.array([12345], np.uint64)  # stands alone
    rows, buckets = [], 3
    nodes = list(sets)
    for low in range(0, len(nodes), gathered):
        some = nodes[low : low + gathered]
        packed = jaccard_join._packed_shingles(
            np.concatenate([sets[i] for i in some]), np.array([len(sets[i]) for i in some]), np.array(some), buckets
        )
        rows += packed.to_pylist()
    want = {}
    for node, values in sets.items():
        for value in values.tolist():
            want.setdefault(value, set()).add(node)
    want = {v: n for v, n in want.items() if len(n) > 1}
    found, dfs, sizes = {}, {}, {}
    for number in range(buckets):
        bucket = jaccard_join._Bucket(number)
        batches = [b for r in rows if r["bucket"] == number for b in bucket.add(r)] + list(bucket.rest())
        for batch in batches:
            for r in batch.to_pylist():
                found.setdefault(r["h"], set()).add(r["node"])
                dfs.setdefault(r["h"], set()).add(r["df"])
                sizes[r["node"]] = r["n"]
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
    assert all(dfs[h] == {min(len(found[h]), common)} for h in found)
    assert all(sizes[i] == len(sets[i]) for i in sizes)


def _boilerplate(spark, count, shared=176, own=24):
    """Documents of a common page and some words of their own: alike, but not enough for a link."""
    page = " ".join(f"p{i}" for i in range(shared + 4))
    texts = [(d, page + " " + " ".join(f"w{d}x{i}" for i in range(own))) for d in range(count)]
    return spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)


def test_documents_that_share_too_much_to_be_told_by_words_and_too_little_to_link_never_meet(spark, monkeypatch):
    made = {}
    by_bands = jaccard_join._by_bands

    def counted(lists):
        asking, answering = by_bands(lists)
        made["lists"] = lists.count()
        made["pairs"] = asking.join(answering, ["h", "band", "side"]).count()
        return asking, answering

    monkeypatch.setattr(jaccard_join, "_by_bands", counted)
    pairs = {}
    for count in (100, 200, 400):
        got = jaccard_join.jaccard_components(_boilerplate(spark, count)).collect()
        assert {r["component_id"] for r in got} == set(range(count))  # Jaccard 0.786: no links
        pairs[count] = made["pairs"]
        assert made["lists"] >= 17 * count
    assert pairs[400] <= 2.2 * max(pairs[200], 400) and pairs[400] <= 8 * 400


@pytest.mark.parametrize("seed", range(4))
def test_bands_lose_no_pair_that_passes_the_filters(spark, seed):
    """All pairs of one list, in all the sizes and places there are, with and without a main group."""
    rng = random.Random(seed)
    entries = []
    for node in range(140):
        n = rng.choice([1, 2, 3, 5, 9, 10, 11, 40, 50, 100, 101, 125, 1000, 1250])
        place = rng.randint(0, n - -(-n * 80 // 100))
        entries.append((1, node, n, place, rng.choice([7, 7, 8, node]), 7))
    lists = spark.createDataFrame(entries, "h bigint, node bigint, n int, place bigint, root bigint, main bigint")
    asking, answering = jaccard_join._by_bands(lists)
    met = asking.alias("a").join(answering.alias("b"), ["h", "band", "side"]).where(
        (F.col("a.root") != F.col("b.root")) & (F.struct("a.n", "a.node") > F.struct("b.n", "b.node"))
    )
    got = {(r[0], r[1]) for r in met.select("a.node", "b.node").collect()}
    assert len(got) == met.count()
    for _, a, n, p, root, _ in entries:
        for _, b, m, q, other, _ in entries:
            behind, least = min(n - p, m - q), -(-(n + m) * 80 // 180)
            if (n, a) > (m, b) and root != other and 100 * m >= 80 * n and behind >= least:
                assert (a, b) in got


def test_jaccard_join_of_a_short_text_before_a_long_one(spark):
    long = "some words " * 420_000
    docs = spark.createDataFrame([(1, "two words"), (2, long), (3, "Two  words")], "doc_id bigint, text string")
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs.coalesce(1)).collect()}
    assert got == {1: (1, 1), 2: (2, 2), 3: (1, 1)}


def test_jaccard_join_of_nothing(spark):
    assert jaccard_components(empty(spark)).collect() == []


def brute_repeats(rows):
    """(kept, spans) of each (id, text), judged by every string's earliest place."""
    first: dict[bytes, tuple] = {}
    n = suffix_dedup.LENGTH
    place = [(1 << 63) - 1 if d is None else d for d, _ in rows]
    raw = [(t or "").encode() for _, t in rows]
    for d, t in zip(place, raw, strict=True):
        for p in range(len(t) - n + 1):
            s = t[p : p + n]
            first[s] = min(first.get(s, (d, p)), (d, p))
    out = []
    for d, t in zip(place, raw, strict=True):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - n + 1):
            if first[t[p : p + n]] < (d, p):
                gone[p : p + n] = True
        out.append((bytes(np.frombuffer(t, np.uint8)[~gone]), int((np.diff(np.r_[0, gone]) == 1).sum())))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 1])
def test_suffix_dedup_equals_all_strings(spark, monkeypatch, hot):
    """By both ways: merged transforms, and string by string for hot anchors."""
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    docs = documents(spark)
    rows = pairs(docs)
    want = [(d, *kept) for (d, _), kept in zip(rows, brute_repeats(rows), strict=True)]
    got = suffix_dedup.remove_repeats(docs, keep=("Node",)).collect()
    assert sorted([(r["id"], bytes(r["kept"]), len(r["spans"])) for r in got], key=key) == sorted(want, key=key)
    assert {r["Node"] for r in got} == {"n"}
    assert all(r["kept_text"].encode() == bytes(r["kept"]) for r in got if r["id"] != 14)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 5])
def test_no_task_gathers_a_hot_anchor(spark, monkeypatch, hot):
    """A passage between different edges: its inner anchors have one context, those of its edges one a document."""
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    passage = prose(60, 1)
    rows = [(i, f"{prose(30, 100 + i)} {passage} {prose(30, 200 + i)}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    keyed = suffix_dedup._keyed(docs.withColumnRenamed("doc_id", "id"))
    firsts = keyed.groupBy("node").agg(suffix_dedup.F.min("id").alias("first"))
    few, split = suffix_dedup._parted(suffix_dedup._occurrences(keyed, firsts, 4))
    gathered, alone = few.groupBy("anchor").count().collect(), split.select("anchor", "key").collect()
    assert (hot > 12) == (max(r["count"] for r in gathered) > 5) == (not alone)
    assert len(set(alone)) == len(alone)
    got = suffix_dedup.remove_repeats(docs).collect()
    want = [(d, *kept) for (d, _), kept in zip(rows, brute_repeats(rows), strict=True)]
    assert sorted((r["id"], bytes(r["kept"]), len(r["spans"])) for r in got) == want


def test_a_bucket_holds_two_anchors_of_a_hot_gram(spark):
    passage = prose(60, 1)
    rows = [(f"{prose(30, 100 + i)} {passage} {prose(30, 200 + i)}",) for i in range(40)]
    docs = spark.createDataFrame(rows, "text string").coalesce(1)
    packed = suffix_dedup._dealt_anchors(docs, 4).collect()
    held: dict[bytes, int] = {}
    for part in packed:
        for k in range(0, len(part["hashes"]) if part["bucket"] >= 0 else 0, 6):
            gram = bytes(part["hashes"][k : k + 6])
            held[gram] = held.get(gram, 0) + 1
    assert max(held.values()) == 2
    got = suffix_dedup._repeated_anchors(suffix_dedup._dealt_anchors(docs, 4), 4).collect()
    places: dict[int, list] = {}
    for (text,) in rows:
        data, bounds = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
        node = int(suffix_dedup.text_hashes(data, bounds)[0])
        at, grams, _, _ = suffix_dedup.anchors(data, bounds)
        for k, gram in zip(at.tolist(), grams.tolist(), strict=True):
            places.setdefault(gram, []).append((node, k))
    want = {p for of in places.values() if len(of) > 1 for p in of}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_buckets_of_anchors_are_even(spark):
    """Selected grams have the least hashes around them; their buckets are alike nevertheless."""
    docs = spark.createDataFrame([(prose(200, i),) for i in range(120)], "text string").coalesce(1)
    held: dict[int, int] = {}
    for part in suffix_dedup._dealt_anchors(docs, 16).collect():
        if part["bucket"] >= 0:
            held[part["bucket"]] = held.get(part["bucket"], 0) + len(part["hashes"]) // 6
    assert len(held) == 16 and sum(held.values()) > 1600
    assert max(held.values()) < 2 * sum(held.values()) / 16


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.remove_repeats(empty(spark)).collect() == []


def test_merged_transforms_find_every_repeat():
    rng = np.random.default_rng(0)
    base = rng.integers(97, 100, 400).astype(np.uint8).tobytes()
    contents = [base[i : i + rng.integers(100, 169)] for i in rng.integers(0, 230, 4000)]  # two shards and more
    ids, starts = rng.integers(0, 500, 4000), rng.integers(0, 10000, 4000)
    want: dict[bytes, tuple] = {}
    for c, d, s in zip(contents, ids.tolist(), starts.tolist(), strict=True):
        for k in range(len(c) - 99):
            want[c[k : k + 100]] = min(want.get(c[k : k + 100], (d, s + k)), (d, s + k))
    found = suffix_dedup.repeated_strings(contents, ids, starts)
    assert len(found[0]) == sum(len(c) - 99 for c in contents)
    for i, k, d, s in zip(*(x.tolist() for x in found), strict=True):
        assert want[contents[i][k : k + 100]] == (d, s)


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def test_decontamination_equals_all_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 200)  # several blocks of phrases
    docs = documents(spark)
    long = dict((d, t) for d, t in pairs(docs) if d == 11)[11].split(" ")
    items = [
        (1, " ".join(long[50:80])), (2, " ".join(long[60:100]).upper()), (3, "One two, THREE"), (3, "é" * 400),
        (4, None), (5, ""), (None, prose(90, 2)), (6, "12"), (7, "not in any document of these at all, is it then now or never"),
    ]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = item_words(text)
        for a in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + 13]), set()).add(item)
    want = []
    for d, text in pairs(docs):
        w, hit, found = item_words(text), set(), set()
        for size in {len(x) for x in windows}:
            for a in range(len(w) - size + 1):
                if tuple(w[a : a + size]) in windows:
                    hit |= set(range(a, a + size))
                    found |= windows[tuple(w[a : a + size])]
        runs = sum(1 for i in hit if i - 1 not in hit)
        want.append((d, len(w), len(hit), runs, sorted(found, key=lambda i: (i is None, i))))
    got = decontaminate.find_contamination(docs, benchmark, keep=("Node",))
    assert got.columns == ["id", "n_words", "n_hit", "spans", "items", "Node"]
    with pytest.raises(ValueError):
        decontaminate.find_contamination(docs, benchmark, keep=("items",))
    got = [(r[0], r[1], r[2], len(r[3]), r[4]) for r in got.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert any(r[2] for r in got)
    assert decontaminate.find_contamination(empty(spark), benchmark).collect() == []
    assert all(not r[2] for r in decontaminate.find_contamination(docs, benchmark.limit(0)).collect())


def test_fm_index_searches_and_locates():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 5, 3000)
    index = decontaminate.FMIndex(text, 5)
    phrases = np.array([text[a : a + 4] for a in rng.integers(0, 2990, 50)] + [[4, 4, 4, 4]])
    low, high = index.search(phrases, np.full(51, 4))
    for phrase, a, b in zip(phrases, low, high, strict=True):
        want = [i for i in range(2997) if (text[i : i + 4] == phrase).all()]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_one_block_of_phrases_is_alive_at_a_time(spark, monkeypatch):
    """Every broadcast is destroyed before the next one, and after the last; blocks unite to what one finds."""
    words = prose(300, 31).split(" ")
    items = [(i, " ".join(words[i * 11 : i * 11 + 30])) for i in range(24)] + [(100, words[5]), (None, " ".join(words[:13]))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    texts = [(d, " ".join(words[d * 7 : d * 7 + 90])) for d in range(30)] + [(40, prose(50, 32)), (41, None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    whole = sorted([tuple(r) for r in decontaminate.find_contamination(docs, benchmark).collect()], key=key)
    live, made = set(), []
    context = type(spark.sparkContext)
    broadcast = context.broadcast

    def watched(self, value):
        if not isinstance(value, decontaminate.Phrases):  # Spark's own
            return broadcast(self, value)
        assert not live
        out = broadcast(self, value)
        live.add(out)
        made.append(len(value.keys))
        destroy = out.destroy
        out.destroy = lambda: (live.discard(out), destroy())
        return out

    monkeypatch.setattr(context, "broadcast", watched)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3000)
    parts = sorted([tuple(r) for r in decontaminate.find_contamination(docs, benchmark).collect()], key=key)
    assert len(made) > 5 and not live and max(made) < sum(made) / 3
    assert parts == whole and sum(r[2] > 0 for r in whole) >= 30


def test_bpe_equals_the_tokenizers_library(spark):
    library = Tokenizer.from_file(PATH)
    docs = documents(spark)
    got = bpe_decode(bpe_encode(docs, PATH), PATH).collect()
    want = []
    for d, text in pairs(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((d, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)
    assert sorted([tuple(r) for r in bpe_round_trip(docs, PATH).collect()], key=key) == sorted(want, key=key)
    assert bpe_encode(empty(spark), PATH).collect() == []


def test_bpe_on_odd_characters():
    library, mine, rng = Tokenizer.from_file(PATH), vocabulary(PATH), random.Random(1)
    pool = ["a", " ", "\n", "'s", "'T", "²", "é", "中", "<|endoftext|>", "<|endof", "\x00", "\x1c", "\x85", "՘", "౜",
            "ab" * 300, "!!!!", "x" * 65, "　"]
    texts = []
    for _ in range(3000):
        own = chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x110000)]))
        texts.append("".join(rng.choice([*pool, own]) for _ in range(rng.randrange(25))))
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(15)]
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_language_id_learns_and_covers_whole_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = fit_language_id(docs)
    judged = predict_language(docs, model).where(held_out()).where("lang IS NOT NULL").selectExpr("avg(int(lang = lang_pred))")
    assert judged.first()[0] >= 0.97
    odd = documents(spark)
    got = predict_language(odd, model)
    assert got.columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} >= {5, 6, 7}
    assert predict_language(empty(spark), model).collect() == []
    assert fit_language_id(odd) is None  # no labels
    assert {r["lang_pred"] for r in predict_language(odd, None).collect()} == {"und"}


def test_the_network_against_plain_loops():
    """Probabilities of a small network on short and full windows, filter by filter and place by place."""
    rng = np.random.default_rng(5)
    widths, count, languages = language_id.WIDTHS, language_id.FILTERS, ("a", "b", "c")
    filters = {w: rng.normal(size=(w, 256, count)).astype(np.float32) for w in widths}
    size = len(widths) * count
    net = language_id.ByteNetwork(
        languages, filters, rng.normal(size=size).astype(np.float32), rng.normal(size=(size, 3)).astype(np.float32),
        rng.normal(size=3).astype(np.float32),
    )
    windows = np.zeros((5, language_id.WINDOW), np.uint8)
    for i, n in enumerate((0, 1, 7, 200, language_id.WINDOW)):
        windows[i, :n] = rng.integers(0, 256, n)
    got = net.predictor()(windows)
    for window, found in zip(windows.tolist(), got, strict=True):
        pooled = []
        for w in widths:
            for f in range(count):
                sums = [
                    sum(float(filters[w][k, window[p + k], f]) for k in range(w)) for p in range(language_id.WINDOW - w + 1)
                ]
                pooled.append(max(sums))
        hidden = net._hidden(np.array([pooled], np.float32))[0]
        score = [sum(float(h) * float(x) for h, x in zip(hidden, net.weights[:, c], strict=True)) + float(net.offset[c]) for c in range(3)]
        exact = np.exp(np.array(score) - max(score))
        assert np.allclose(found, exact / exact.sum(), atol=1e-4)


def test_the_sample_has_the_least_hashes_of_each_language(spark):
    """A hot id, rare languages, texts without a letter: the same as sorting all documents."""
    rng = random.Random(4)
    data = [(i, f"text {i}", "hot" if i % 3 else "b") for i in range(3000)] + [(7, f"again {i}", "hot") for i in range(2000)]
    data += [(i, "123", "digits") for i in range(5000, 5400)] + [(i, "a letter", "digits") for i in range(5400, 5460)]
    data += [(9000, "x", "one"), (None, "x", "one"), (9001, None, "one"), (9002, "y", None)]
    rng.shuffle(data)
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string").repartition(5)
    rows = docs.selectExpr("lang", "doc_id AS id", "array(text) AS text", "xxhash64(doc_id, 5) AS hash").where(
        "lang IS NOT NULL AND id IS NOT NULL AND text[0] RLIKE '[a-z]'"
    )
    sizes = {r["lang"]: r["n"] for r in docs.where("lang IS NOT NULL").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    found = language_id._least_hashes(rows, sizes, 50).collect()
    want = {}
    for r in rows.collect():
        own = want.setdefault(r["lang"], {})
        own[r["hash"], r["id"]] = min(own.get((r["hash"], r["id"]), r["text"]), r["text"])
    for lang, ids in want.items():
        got = {(r["hash"], r["id"]): r["text"] for r in found if r["lang"] == lang}
        assert len(got) == sum(r["lang"] == lang for r in found)  # an id once
        least = sorted(ids)[:50]
        assert sorted(got)[:50] == least and all(got[k] == ids[k] for k in least)
        assert len(got) <= 400  # bounded, however many rows there are


def test_windows_hold_every_byte_once():
    data = np.arange(1, 1000, dtype=np.uint64).astype(np.uint8)
    bounds = np.array([0, 0, 256, 300, 999])
    windows, row, size = cut_windows(data, bounds)
    for i in range(4):
        got = np.concatenate([w[:n] for w, n in zip(windows[row == i], size[row == i], strict=True)] or [data[:0]])
        assert (got == data[bounds[i] : bounds[i + 1]]).all()


def _runs(text):
    words = re.findall("[a-z0-9]+", (text or "").lower())
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def _best_runs(rows, known):
    """(id, license, shared, shingles, first word) by trying every start of every text."""
    want = []
    for d, text in rows:
        s = _runs(text)
        for name, statement in known.items():
            t = set(_runs(statement))
            held = [(len(t & set(s[a : a + 2 * len(t)])), -a) for a in range(len(s)) if s[a] in t]
            if held and max(held)[0] * 100 >= 80 * len(t):
                want.append((d, name, max(held)[0], len(t), -max(held)[1]))
    return sorted(want, key=key)


def _sql_of(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in rows])
    found = con.sql(SQL_LICENSES).to_arrow_table().select(["doc_id", "license", "n_shared", "n_shingles", "first_word"])
    return sorted(zip(*[c.to_pylist() for c in found.columns], strict=True), key=key)


def test_license_scan_equals_exact_containment(spark):
    templates = license_scan.statements(spark)
    notice = license_scan.STATEMENTS["MIT-notice"]
    rows = [
        (1, f"{prose(40, 1)} {notice} {prose(40, 2)}"), (1, "released UNDER the mit -- license"), (2, None), (None, notice),
        (3, notice.replace("free of charge", "at no cost")), (4, " ".join(notice.split(" ")[:12])), (5, ""),
        (6, prose(5000, 3) + " Licensed under CC BY-SA 4.0."), (7, f"{notice} {prose(3, 9)} {notice}"),
        (8, f"{notice} {prose(500, 8)} {notice}"),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, license int")
    got = license_scan.scan_licenses(docs, templates).collect()
    assert sorted([tuple(r) for r in got], key=key) == _best_runs(rows, license_scan.KNOWN)
    assert license_scan.scan_licenses(empty(spark), templates).collect() == []
    assert license_scan.scan_licenses(docs, templates.limit(0)).collect() == []
    plan = license_scan.scan_licenses(docs, templates)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_license_scan_does_not_depend_on_the_place(spark):
    """A statement altered in its middle at every place: every start of every text, and the SQL, give the same rows."""
    words = license_scan.STATEMENTS["ISC"].split(" ")
    texts = [
        f"{prose(place, 5)} {' '.join(words[:17])} {prose(more, 6)} {' '.join(words[17:])} {prose(70, 7)}"
        for more in (5, 8, 20, 40) for place in range(31)
    ]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted([tuple(r) for r in license_scan.scan_licenses(docs, license_scan.statements(spark)).collect()], key=key)
    assert got == _best_runs(rows, license_scan.KNOWN) == _sql_of(rows)
    assert sum(r[0] // 31 == 1 for r in got) == 31  # with eight words in it, found at all places


@pytest.mark.parametrize("name", sorted(license_scan.PASSAGES))
def test_whole_license_texts_are_known(name):
    assert 40 <= len(license_scan.PASSAGES[name].split()) <= 400


def test_license_texts_are_found_altered_and_cut(spark):
    """Each text whole, with a word of nine changed, without its first sixth, and cut to half (too little)."""
    rows = []
    for text in license_scan.PASSAGES.values():
        words = text.split(" ")
        changed = [w if i % 43 else "something" for i, w in enumerate(words)]
        for some in (words, changed, words[len(words) // 6 :], words[: len(words) // 2]):
            rows.append((len(rows), f"{prose(len(rows) * 7 % 97, len(rows))} {' '.join(some)} {prose(60, 3)}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted([tuple(r) for r in license_scan.scan_licenses(docs, license_scan.statements(spark)).collect()], key=key)
    assert got == _best_runs(rows, license_scan.KNOWN) == _sql_of(rows)
    found = {r[:2] for r in got}
    for i, name in enumerate(license_scan.PASSAGES):
        assert all((4 * i + j, name) in found for j in range(3)) and (4 * i + 3, name) not in found


def test_digest_of_texts_is_of_their_bytes():
    import pyarrow as pa

    from incidentry.llm.common import text_of

    texts = ["a", "b", "a", "", "é", "a" * 70000, "a" * 70000]
    got = suffix_dedup.text_hashes(*text_of(pa.array(texts))).tolist()
    same = {(i, j) for i in range(7) for j in range(i) if got[i] == got[j]}
    assert same == {(2, 0), (6, 5)} and hashlib.sha256(b"").digest()
