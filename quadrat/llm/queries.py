"""The training-data queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import (
    centroids,
    columnwise,
    decontaminate,
    manifest,
    mixing,
    neardup,
    pii,
    piececounts,
    quality,
    sharding,
    tokenids,
    toxicity,
    urlfilter,
)
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL twin where there is one."""

    def register(run):
        QUERIES[name] = lambda spark, sf_dir: run(configure(spark), sf_dir)
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return register


@query(
    "op1_decontaminate",
    r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS span FROM bw WHERE len(w) > 0),
wins AS (
  SELECT DISTINCT item_id, span, array_to_string(w[i:i + span - 1], ' ') AS passage
  FROM (SELECT item_id, w, span, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items)),
spans AS (SELECT DISTINCT span FROM wins),
placed AS (
  SELECT doc_id, span, i, array_to_string(w[i:i + span - 1], ' ') AS passage
  FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS i FROM dw, spans WHERE len(w) >= span)),
hits AS (SELECT doc_id, i, p.span, item_id FROM placed p JOIN wins v ON p.span = v.span AND p.passage = v.passage),
words AS (SELECT DISTINCT doc_id, unnest(range(i, i + span)) AS at FROM hits),
n AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN n USING (doc_id) LEFT JOIN ids USING (doc_id)""",
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


@query(
    "op7_setsketch_neardup",
    r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN []
    ELSE list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
one AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 75 * (na + nb - common)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM reach r JOIN ends e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c USING (doc_id)""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def _draws(path: str, children: list[tuple[str, float]]) -> str:
    one = "-ln((CAST('0x' || left(md5('{p}/{c}:' || doc_id), 13) AS BIGINT) + 0.5) / 4503599627370496.0) / {w}"
    return "[" + ", ".join(one.format(p=path, c=c, w=w) for c, w in children) + "]"


def _shard_sql(node: dict, path: str = "") -> str:
    """The descent as nested SQL conditions, written from the tree."""
    names = list(node)
    below = [
        _shard_sql(node[n], f"{path}/{n}") if isinstance(node[n], dict) else str(n) for n in names
    ]
    if len(names) == 1:
        return below[0]
    draws = _draws(path, [(n, sharding._weight(node[n])) for n in names])
    cases = " ".join(f"WHEN {k + 1} THEN {b}" for k, b in enumerate(below))
    return f"CASE list_position({draws}, list_min({draws})) {cases} END"


@query(
    "op3_hash_tree_shards",
    rf"""
WITH RECURSIVE bits AS (
  SELECT CAST(n AS BIGINT) AS n, CAST(n AS BIGINT) AS c, 0 AS k FROM range(256) t(n)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
bytes AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS b, hex(encode(coalesce(text, ''))) AS x FROM documents),
sums AS (
  SELECT doc_id, CAST(b + 8 AS BIGINT) AS size, xor(4294967295, list_reduce(
    list_transform(range(0, 2 * b, 2), lambda i: CAST('0x' || x[i + 1:i + 2] AS BIGINT)),
    lambda c, v: xor(c >> 8, t[1 + (xor(c, v) & 255)]), CAST(4294967295 AS BIGINT))) AS text_crc32
  FROM bytes, crc),
placed AS (
  SELECT doc_id, size, text_crc32, {_shard_sql(sharding.tree_of(24))} AS shard,
    {_shard_sql(sharding.tree_of(25))} AS grown_shard,
    CAST('0x' || left(md5('slot:' || doc_id || ':' || text_crc32), 15) AS BIGINT) AS key FROM sums)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY key, doc_id, size, text_crc32) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard FROM placed""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents")).withColumn("law", F.lit("key"))


@query(
    "op6_mix_to_weights",
    r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || left(md5('mix:' || doc_id), 15) AS BIGINT) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
l AS (SELECT *, 3 * source_size AS lim, 3 * source_size / weight AS full_at FROM w),
o AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(lim) OVER before, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM l WINDOW before AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, max(CASE WHEN level <= full_at THEN level END) OVER () AS common FROM o),
t AS (
  SELECT source, source_size,
    least(CASE WHEN level <= full_at THEN common * weight ELSE CAST(lim AS DOUBLE) END, CAST(lim AS DOUBLE)) AS target
  FROM c),
p AS (
  SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
    CAST(coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
  FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM p)
SELECT doc_id, size, source_size, target,
  CAST(whole * size + greatest(0, least(budget - whole * source_size - ahead, size)) AS BIGINT) AS taken
FROM e""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(read(spark, sf_dir, "documents")).drop("row")


@query("op4_repair_token_ids")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_table(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op2_toxicity_chain")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.judge(docs, labels).drop("row")


@query("op5_decision_list")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op8_piece_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = piececounts.byte_vocabulary(tokenizer_file("byte_bpe_50k.json"), lone_blank=True)
    return piececounts.count_pieces(read(spark, sf_dir, "documents"), vocabulary)


@query(
    "op10_bloom_cascade",
    r"""
WITH p AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/')
      THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM p),
listed AS (SELECT DISTINCT host || path AS key FROM p WHERE regexp_matches(url, '[?&]utm_[a-z]+='))
SELECT page_id, host, path, rule, CASE rule WHEN 'com/' THEN 'allow' WHEN 'www.example.com/en/' THEN 'allow'
    ELSE CASE WHEN rule IS NOT NULL OR host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END
  END AS verdict
FROM r""",
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, urlfilter.tracked_keys(pages))


@query("op9_pii_bootstrap")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.report(read(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], digest, "spans")


def _manifest_sql(levels: int = 6) -> str:
    """The tree level by level, for sources (and tables of sources) of up to 16^levels."""

    def tree(name: str, leaves: str) -> list[str]:
        out = [f"{name}0 AS ({leaves})"]
        for k in range(levels):
            run = "PARTITION BY g, idx // 16 ORDER BY idx ROWS BETWEEN"
            out += [
                f"""{name}s{k} AS (SELECT g, idx,
  coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE width > 1)""",
                f"""{name}{k + 1} AS (SELECT g, idx // 16 AS idx, sha256(string_agg(h, '' ORDER BY idx)) AS h,
  (width + 15) // 16 AS width FROM {name}{k} WHERE width > 1 GROUP BY g, idx // 16, width)""",
            ]
        ends = " UNION ALL ".join(f"SELECT g, h FROM {name}{k} WHERE width = 1" for k in range(levels + 1))
        return [*out, f"{name}root AS ({ends})"]

    def field(name: str) -> str:
        return f"coalesce(octet_length(encode(CAST({name} AS VARCHAR))) || ':' || {name}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [f"x{k}" for k in range(levels)] + [f"y{k}" for k in range(levels)]
    joins = " ".join(
        [f"LEFT JOIN bs{k} x{k} ON x{k}.g = p.g AND x{k}.idx = p.idx // {16**k}" for k in range(levels)]
        + [f"LEFT JOIN ts{k} y{k} ON y{k}.idx = p.g // {16**k}" for k in range(levels)]
    )
    proof = " || ".join(f"coalesce({s}.l || {s}.r, '')" for s in steps)
    parts = ["f0 AS (SELECT *, coalesce(other, leaf) AS f FROM joined)"]
    for k in range(len(steps)):
        step = f"CASE WHEN l{k} IS NULL THEN f ELSE sha256(l{k} || f || r{k}) END AS f"
        parts.append(f"f{k + 1} AS (SELECT * EXCLUDE (f), {step} FROM f{k})")
    sides = ", ".join(f"{s}.l AS l{k}, {s}.r AS r{k}" for k, s in enumerate(steps))
    polynomial = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return ",\n".join(
        [
            f"""WITH RECURSIVE bits AS (
  SELECT CAST(n AS BIGINT) AS n, CAST(n AS BIGINT) AS c, 0 AS k FROM range(256) t(n)
  UNION ALL SELECT n, {polynomial}, k + 1 FROM bits WHERE k < 8)""",
            "crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8)",
            """sums AS (SELECT DISTINCT doc_id, xor(4294967295, list_reduce(
  list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)),
  lambda c, v: xor(c >> 8, t[1 + (xor(c, v) & 255)]), CAST(4294967295 AS BIGINT))) AS crc32 FROM documents, crc)""",
            "src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT source FROM documents))",
            f"""hashed AS (SELECT d.doc_id, d.source, g, {leaf("text")} AS leaf,
  CASE WHEN crc32 % 5 = 0 THEN {leaf(lower)} END AS other
  FROM (SELECT doc_id, source, lang, n_chars, text FROM documents) d
  JOIN (SELECT source AS s, g FROM src) ON s IS NOT DISTINCT FROM d.source
  LEFT JOIN (SELECT doc_id AS i, crc32 FROM sums) ON i = d.doc_id)""",
            """p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
  count(*) OVER (PARTITION BY g) AS width FROM hashed)""",
            *tree("b", "SELECT g, idx, leaf AS h, width FROM p"),
            *tree("t", "SELECT 0 AS g, g AS idx, h, count(*) OVER () AS width FROM broot"),
            f"""joined AS (SELECT doc_id, leaf, other, broot.h AS subroot, troot.h AS root, sha256({proof}) AS proof_sha256, {sides}
  FROM p JOIN broot USING (g) CROSS JOIN troot {joins})""",
            *parts,
        ]
    ) + f"""
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(steps)}"""


@query("op11_merkle_manifest", _manifest_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(read(spark, sf_dir, "documents")).drop("source", "path")


@query(
    "op12_columnwise_repeats",
    r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
long AS MATERIALIZED (SELECT r, x, CAST(length(x) // 2 AS BIGINT) AS n FROM d WHERE length(x) >= 800),
parts AS (
  SELECT r, pos, substr(x, 2 * pos + 1, 2 * 1399) AS part FROM (SELECT r, x, unnest(range(0, n - 399, 1000)) AS pos FROM long)),
strings AS MATERIALIZED (
  SELECT r, pos + k AS pos, md5_number(substr(part, 2 * k + 1, 800)) AS s
  FROM (SELECT r, pos, part, unnest(range(0, least(1000, length(part) // 2 - 399))) AS k FROM parts)),
again AS (SELECT s FROM strings GROUP BY s HAVING count(*) > 1),
hits AS (SELECT r, pos FROM strings WHERE s IN (SELECT s FROM again)),
marked AS (SELECT r, pos, pos - lag(pos) OVER (PARTITION BY r ORDER BY pos) AS gap FROM hits),
runs AS (SELECT r, pos, sum(CASE WHEN gap <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY pos) AS k FROM marked),
spans AS (SELECT r, k, min(pos) AS a, max(pos) + 400 AS b FROM runs GROUP BY r, k),
kept AS (
  SELECT r, substr(x, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS piece, a, b
  FROM spans JOIN long USING (r) WINDOW w AS (PARTITION BY r ORDER BY a)),
whole AS (
  SELECT r, string_agg(piece, '' ORDER BY a) || substr(any_value(x), 2 * max(b) + 1) AS x,
    CAST(sum(b - a) AS BIGINT) AS removed, count(*) AS spans FROM kept JOIN long USING (r) GROUP BY r)
SELECT doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, coalesce(removed, 0) AS n_removed,
  coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(whole.x, d.x))) AS kept_sha256
FROM d LEFT JOIN whole USING (r)""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = columnwise.report(read(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def _centroid_sql(rounds: int = centroids.ROUNDS) -> str:
    """All rounds written out; exact integers throughout."""
    near = """SELECT vec_id, q, min(CAST(list_sum(list_transform(range(1, 65),
  lambda i: (q[i] - z[i]) * (q[i] - z[i]))) AS BIGINT) * 8 + c) AS best FROM (SELECT rowid AS id, * FROM v), c{k} GROUP BY id, vec_id, q"""
    parts = [
        """v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rowid,
  list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, q AS z FROM v
  ORDER BY c LIMIT 8)""",
    ]
    for k in range(rounds):
        parts += [
            f"a{k} AS MATERIALIZED ({near.format(k=k)})",
            f"""m{k} AS (SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS z FROM (
  SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
    SELECT best % 8 AS c, unnest(range(1, 65)) AS i, unnest(q) AS x FROM a{k}) GROUP BY c, i) GROUP BY c)""",
            f"c{k + 1} AS MATERIALIZED (SELECT c, coalesce(m{k}.z, c{k}.z) AS z FROM c{k} LEFT JOIN m{k} USING (c))",
        ]
    return "WITH " + ",\n".join([*parts, f"a AS MATERIALIZED ({near.format(k=rounds)})"]) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, best // 8 AS distance,
  CAST(sum(best // 8) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best // 8) OVER () AS BIGINT) AS inertia, sha256(array_to_string(z, ',')) AS centroid_sha256
FROM a JOIN c{rounds} ON c = best % 8"""


@query("op13_table_centroids", _centroid_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.report(read(spark, sf_dir, "embeddings"))
