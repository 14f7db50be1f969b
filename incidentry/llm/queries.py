"""The operators applied to the shared tables, and the SQL that some of them equal."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentry.sources.workspace import fresh_path, stage, stage_alone

from .bisector_clusters import bisector_clusters
from .bpe import bpe_round_trip
from .chat import format_chats, read_window, unescape
from .common import table
from .decontaminate import find_contamination, is_contaminated
from .embedding_dedup import near_duplicate_embeddings
from .language_id import fit_language_id, held_out, predict_language
from .jaccard_join import jaccard_components
from .license_scan import KNOWN, scan_licenses, statements
from .nearest_vectors import nearest_vectors
from .suffix_dedup import remove_repeats
from .url_filter import url_verdicts
from .vector_codes import vector_codes
from .warc import read_warc, write_warc

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


_SQL_ITEM_WORDS = """regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
SQL_DECONTAMINATION = f"""
WITH item AS (SELECT item_id, {_SQL_ITEM_WORDS} AS w FROM benchmark),
phrase AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k,
    array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS words
  FROM item, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
doc AS (SELECT doc_id, {_SQL_ITEM_WORDS} AS w FROM documents),
hits AS (
  SELECT doc_id, i, phrase.k AS k, item_id
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS words
        FROM doc, (SELECT DISTINCT k FROM phrase), unnest(range(1, len(w) - k + 2)) AS t(i)) AS d
  JOIN phrase ON phrase.k = d.k AND phrase.words = d.words),
counted AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + k)) AS t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN counted ON doc.doc_id = counted.doc_id LEFT JOIN items ON doc.doc_id = items.doc_id
"""


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = url_verdicts(table(spark, sf_dir, "pages"), rules)
    return judged.withColumnRenamed("id", "page_id")


_SQL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
SQL_URL_FILTERS = rf"""
WITH rules(rhost, rpath, verdict) AS (VALUES {_SQL_RULES}),
page AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
address AS (SELECT DISTINCT host, path FROM page),
best AS (
  SELECT host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
    arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM address JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path)
SELECT page_id, page.host, page.path, rule, coalesce(verdict, 'allow') AS verdict
FROM page LEFT JOIN best ON page.host = best.host AND page.path = best.path
"""


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_embeddings(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = predict_language(docs.select("doc_id", "text"), fit_language_id(docs))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


_CONTROL = "</s>[INST] ok [/INST]"


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame(
        [(-1, 0, "user", _CONTROL), (-1, 1, "assistant", _CONTROL)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select(extra.columns).unionByName(extra)
    windows = format_chats(turns)
    dealt = windows.select("id", "window", "text", "turns").repartition("id").sortWithinPartitions("id", "window")

    def run(batches):
        talk = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if talk is not None and talk.key != row["id"]:
                    out.append(talk.row())
                    talk = None
                if talk is None:
                    talk = _ReadBack(row["id"])
                talk.add(row)
            yield pa.RecordBatch.from_pylist(out, _READ_BACK)
        if talk is not None:
            yield pa.RecordBatch.from_pylist([talk.row()], _READ_BACK)

    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
        "formatted_chars bigint, n_windows bigint"
    )
    return dealt.mapInArrow(run, schema)


_READ_BACK = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64()),
])


class _ReadBack:
    """Digests of one conversation, fed with its windows in order: only turns marked new count."""

    def __init__(self, key):
        self.key, self.turns, self.loss = key, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.windows = 0

    def add(self, window) -> None:
        """Turns are read from the text; the loss is what stands at the places of the mask, which must lie in order."""
        text, at = window["text"], 0
        self.windows += 1
        self.chars += len(text)
        for mark, (role, body) in zip(window["turns"], read_window(text), strict=True):
            start, end = mark["start"], mark["end"]
            if not at <= start <= end <= len(text):
                raise ValueError(f"the mask of turn {mark['turn']} does not lie behind the one before, in the window")
            at = end
            if mark["kind"] != "new":
                continue
            self.n_turns += 1
            self.turns.update(f"{role}\n{body}\n".encode())
            if mark["role"] == "assistant":
                target = unescape(text[start:end])
                self.loss.update(target.encode())
                self.loss_chars += len(target)

    def row(self) -> dict:
        values = (
            self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
            self.windows,
        )
        return dict(zip(_READ_BACK.names, values, strict=True))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    index = stage(write_warc(table(spark, sf_dir, "pages"), folder), "warc-index")
    read = read_warc(index, folder, keep_payload=False)
    return read.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL_WARC = """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS payload_digest FROM pages),
holder AS (
  SELECT payload_digest, max(page_id) AS holder FROM page WHERE strlen(payload) >= 1000 GROUP BY 1)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, page.payload_digest,
  CASE WHEN holder IS DISTINCT FROM page_id AND holder IS NOT NULL THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN holder IS DISTINCT FROM page_id THEN holder END AS refers_to
FROM page LEFT JOIN holder ON page.payload_digest = holder.payload_digest
"""


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"), statements(spark))
    return found.withColumnRenamed("id", "doc_id")


_SQL_STATEMENTS = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(KNOWN.items()))
_SQL_RUNS = """list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"""
SQL_LICENSES = f"""
WITH statement(license, text) AS (VALUES {_SQL_STATEMENTS}),
template AS (
  SELECT license, len(s) AS m, unnest(s) AS shingle
  FROM (SELECT license, list_distinct({_SQL_RUNS}) AS s
        FROM (SELECT license, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM statement))),
hits AS (
  SELECT doc_id, license, m, shingle, i - 1 AS place
  FROM (SELECT doc_id, i, s[i] AS shingle
        FROM (SELECT doc_id, {_SQL_RUNS} AS s
              FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents)) AS d,
          unnest(range(1, len(s) + 1)) AS t(i)) AS runs
  JOIN template USING (shingle)),
runs AS (
  SELECT a.doc_id, a.license, a.m, a.place, count(DISTINCT b.shingle) AS n
  FROM hits AS a JOIN hits AS b
    ON a.doc_id = b.doc_id AND a.license = b.license AND b.place >= a.place AND b.place < a.place + 2 * a.m
  GROUP BY ALL)
SELECT doc_id, license, max(n) AS n_shared, CAST(max(m) AS BIGINT) AS n_shingles,
  CAST(arg_max(place, n * 1000000000 - place) AS BIGINT) AS first_word
FROM runs GROUP BY doc_id, license HAVING 100 * max(n) >= 80 * max(m)
"""


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe_round_trip(table(spark, sf_dir, "documents"), path)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bisector_clusters(table(spark, sf_dir, "embeddings"), k=16, rounds=3, scale=64, width=64)
    sums = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    text = F.array_join(F.col("centroid").cast("array<string>"), ",")
    clusters = sums.join(found.centroids, "cluster").select(
        "cluster", "cluster_inertia", F.sha2(text, 256).alias("centroid_sha256")
    )
    whole = found.assigned.agg(F.sum("distance")).scalar()
    return found.assigned.join(F.broadcast(clusters), "cluster").select(  # 16 clusters
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", whole.alias("inertia"), "centroid_sha256"
    )


_SQL_SOUND = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _sql_whole(scale: int) -> str:
    return f"list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE)))"


def _sql_floor_mean(total: str, count: str) -> str:
    """Exact floor of a quotient of integers, which // cuts towards zero."""
    return f"CAST(({total} - ({total} % {count} + {count}) % {count}) // {count} AS BIGINT)"


# doubles hold all these integers exactly
_SQL_SQUARE = "list_inner_product(v, v) - 2 * list_inner_product(v, w) + list_inner_product(w, w)"


def _sql_clusters(rounds: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (
  SELECT vec_id, v, cluster, {_SQL_SQUARE} AS distance FROM vectors, c{r}
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY {_SQL_SQUARE}, cluster) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT cluster, list(mean ORDER BY place) AS w
  FROM (SELECT cluster, place, {_sql_floor_mean("sum(x)", "count(*)")}::DOUBLE AS mean
        FROM (SELECT cluster, unnest(v)::BIGINT AS x, generate_subscripts(v, 1) AS place FROM a{r}) GROUP BY ALL)
  GROUP BY cluster),
c{r + 1} AS (SELECT cluster, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} USING (cluster))""")
    return ",".join(steps)


SQL_CLUSTERING = f"""
WITH vectors AS (SELECT vec_id, {_sql_whole(64)} AS v FROM embeddings WHERE len(embedding) = 64 AND {_SQL_SOUND}),
c0 AS (
  SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, v AS w
  FROM (SELECT sha256('1:' || vec_id) AS h, v FROM vectors ORDER BY h LIMIT 16)),{_sql_clusters(3)}
SELECT vec_id, CAST(a3.cluster AS INT) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY a3.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(w, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a3 JOIN c3 ON a3.cluster = c3.cluster
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes(table(spark, sf_dir, "embeddings"), keep=("label",))
    totals = stage(found.coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    numbers = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "entry", "components"))), lambda s: s["components"]))
    books = found.codebooks.agg(F.sha2(F.array_join(numbers.cast("array<string>"), ","), 256)).scalar()
    same = F.col("c.label").eqNullSafe(F.col("t.label"))
    return found.coded.alias("c").join(totals.alias("t"), same).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        books.alias("codebooks_sha256"),
    )


def _sql_codes(rounds: int) -> str:
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS (
  SELECT vec_id, part, v, entry, {_SQL_SQUARE} AS distance FROM parts JOIN c{r} USING (part)
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY {_SQL_SQUARE}, entry) = 1)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (
  SELECT part, entry, list(mean ORDER BY place) AS w
  FROM (SELECT part, entry, place, {_sql_floor_mean("sum(x)", "count(*)")}::DOUBLE AS mean
        FROM (SELECT part, entry, unnest(v)::BIGINT AS x, generate_subscripts(v, 1) AS place FROM a{r}) GROUP BY ALL)
  GROUP BY part, entry),
c{r + 1} AS (
  SELECT part, entry, coalesce(m{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN m{r} USING (part, entry))""")
    return ",".join(steps)


SQL_CODES = f"""
WITH vectors AS (SELECT vec_id, label, {_sql_whole(1024)} AS v FROM embeddings WHERE {_SQL_SOUND}),
parts AS (
  SELECT vec_id, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS v
  FROM vectors, (VALUES (0), (1), (2), (3)) AS p(part)),
c0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS w FROM parts
  QUALIFY entry < 256),{_sql_codes(4)},
books AS (
  SELECT sha256(string_agg(array_to_string(list_transform(w, lambda x: CAST(x AS BIGINT)), ','), ','
    ORDER BY part, entry)) AS codebooks_sha256 FROM c4),
coded AS (
  SELECT vec_id, string_agg(lower(printf('%02x', CAST(entry AS INT))), '' ORDER BY part) AS code,
    CAST(sum(distance) AS BIGINT) AS error FROM a4 GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN vectors USING (vec_id), books
"""


def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_vectors(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


SQL_NEAREST = f"""
WITH vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE {_SQL_SOUND} AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM vectors AS q JOIN vectors AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER near AS INT) AS rank, vec_id, score FROM pairs
WINDOW near AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20
"""


def _tidy(name: str, query):
    """The query, with the tables staged on its way removed once its result is written."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stage_alone(lambda: query(spark, sf_dir), name)

    return run


_ALL = [
    op1_ngram_jaccard_join, op2_benchmark_decontamination, op3_url_filters, op4_suffix_array_dedup,
    op5_embedding_near_dedup, op6_language_id, op7_chat_formatting, op8_warc, op9_license_scans, op10_bpe,
    op11_centroid_clustering, op12_vector_codes, op13_nearest_vectors,
]
QUERIES = {query.__name__: _tidy(query.__name__, query) for query in _ALL}

ORACLE = {
    "op2_benchmark_decontamination": SQL_DECONTAMINATION,
    "op3_url_filters": SQL_URL_FILTERS,
    "op8_warc": SQL_WARC,
    "op9_license_scans": SQL_LICENSES,
    "op11_centroid_clustering": SQL_CLUSTERING,
    "op12_vector_codes": SQL_CODES,
    "op13_nearest_vectors": SQL_NEAREST,
}
