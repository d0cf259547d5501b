"""The queries opN_<name>, each applying one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every text, encoded and decoded by the tokenization automaton."""
    from flowwarden.llm.bpe import Automaton, encode_decode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, Automaton.load(tokenizer_path())).drop("text")


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document: three-word shingles, similarity of 0.85 or more."""
    from flowwarden.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines before and after dropping those that an earlier document holds, and the kept text's digest."""
    from pyspark.sql import functions as F

    from flowwarden.llm.linededup import dedup_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op6_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, pos, line, k, length(k) >= 10 AS counts
  FROM (SELECT doc_id, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
        FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS pos
              FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)))),
shared AS (
  SELECT k, min(doc_id) AS first FROM lines WHERE counts GROUP BY k HAVING min(doc_id) < max(doc_id)),
judged AS (
  SELECT l.doc_id, l.pos, l.line, s.first IS NOT NULL AND l.doc_id > s.first AS gone
  FROM lines l LEFT JOIN shared s ON l.counts AND l.k = s.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, ...) of every benchmark item that stands in a document, exactly or nearly."""
    from flowwarden.llm.decontam import contaminations

    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document, by a model that never saw the held-out quarter."""
    from pyspark.sql import functions as F

    from flowwarden.llm.langid import identify, train
    from flowwarden.llm.text import held_out

    docs = table(spark, sf_dir, "documents")
    model = train(docs)
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base patterns, and all spans with novel strings."""
    from pyspark.sql import functions as F

    from flowwarden.llm.secret_scan import count_kind, joined, scan

    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        *[count_kind(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
        count_kind(spans, "novel").alias("n_novel"),
    )


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and license labels of every document."""
    from flowwarden.llm.license_scan import scan

    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "detections")


@query
def op9_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by its labelled neighbours, none of them held out."""
    from pyspark.sql import functions as F

    from flowwarden.llm.knn_quality import score, train
    from flowwarden.llm.text import held_out

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


#: The rules of op5.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; where no rule fits, hosts with any link that carries a tracking mark are blocked."""
    from pyspark.sql import functions as F

    from flowwarden.llm.urlfilter import host_path, judge

    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    tracked = pages.filter(F.col("url").contains("utm_")).select(host_path(F.col("url"))[0].alias("host"))
    return judge(pages, URL_RULES, tracked).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op5_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
tracked AS (SELECT DISTINCT host FROM parts WHERE contains(url, 'utm_')),
rules(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
best AS (
  SELECT p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) p
  JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY p.host, p.path)
SELECT p.page_id, p.host, p.path, b.rule,
       CASE WHEN b.rule IS NOT NULL THEN b.verdict WHEN t.host IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM parts p LEFT JOIN best b ON b.host = p.host AND b.path = p.path LEFT JOIN tracked t ON t.host = p.host"""


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every document, the base rules, and the outliers of its language and source."""
    from flowwarden.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents"))


@query
def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they and the next text's are."""
    from pyspark.sql import functions as F

    from flowwarden.llm.order_minhash import edits, written

    out = edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("signature")).alias("fingerprint"),
        written(F.col("edited_signature")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the four leading components of the distinct vectors."""
    from pyspark.sql import functions as F

    from flowwarden.llm.whitening import whiten

    out = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), weights="one")
    parts = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "part")
    return out.select("vec_id", "n", "deviation", "identity_error", parts).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "part.whitened", "part.explained", "identity_error"
    )


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle proof of every document, folded again from texts of which a fifth was tampered with."""
    from pyspark.sql import functions as F

    from flowwarden.llm.merkle import audit

    docs = table(spark, sf_dir, "documents")
    lowered = {"text": F.translate("text", UPPER, LOWER)}
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return audit(docs, MANIFEST_FIELDS, lowered, fifth)


def _manifest_sql(levels: int = 6, arity: int = 16) -> str:
    """The manifest in SQL, as many levels as it may need written out; a tree that is done passes them unchanged."""
    coded = " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" for c in MANIFEST_FIELDS[:-1])
    last = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}) || ':' || {0} END"
    # CRC-32, bit by bit: a byte is put in, or -1 stands for a shift.
    digits = "string_split(CAST(doc_id AS VARCHAR), '')"
    ops = f"list_prepend(4294967295, flatten(list_transform({digits}, x -> [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1])))"
    crc = f"xor(list_reduce({ops}, lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"
    crc = crc.replace("x -> [", "lambda x: [").replace("[ascii(x)", "[CAST(ascii(x) AS BIGINT)").replace("list_prepend(4294967295", "list_prepend(CAST(4294967295 AS BIGINT)")
    parts = [
        f"""docs AS (SELECT *, coalesce('=' || source, '') AS k, {crc} % 5 = 0 AS fifth FROM documents)""",
        f"""leaves AS (SELECT doc_id, k, row_number() OVER (PARTITION BY k ORDER BY doc_id) - 1 AS p, count(*) OVER (PARTITION BY k) AS n,
  sha256({coded} || {last.format("text")}) AS leaf,
  CASE WHEN fifth THEN sha256({coded} || {last.format(f"translate(text, '{UPPER}', '{LOWER}')")}) END AS bent FROM docs)""",
        "a0 AS (SELECT k, p AS i, n, leaf AS h FROM leaves)",
        "f0 AS (SELECT doc_id, k, p, coalesce(bent, leaf) AS f, '' AS proof FROM leaves)",
    ]

    def climb(node: str, path: str, at: int) -> list[str]:
        return [
            f"""{node}{at + 1} AS (SELECT k, i // {arity} AS i, (n + {arity - 1}) // {arity} AS n,
  CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {node}{at} GROUP BY k, i // {arity}, n)""",
            f"""{path}{at + 1} AS (SELECT doc_id, f.k, p // {arity} AS p,
  CASE WHEN any_value(n) = 1 THEN any_value(f) ELSE sha256(string_agg(CASE WHEN l.i = p THEN f ELSE h END, '' ORDER BY l.i)) END AS f,
  any_value(proof) || coalesce(string_agg(h, '' ORDER BY l.i) FILTER (WHERE n > 1 AND l.i <> p), '') AS proof
  FROM {path}{at} f JOIN {node}{at} l ON l.k = f.k AND l.i // {arity} = p // {arity} GROUP BY doc_id, f.k, p)""",
        ]

    for at in range(levels):
        parts += climb("a", "f", at)
    parts += [
        f"tops AS (SELECT k AS name, h, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n FROM a{levels})",
        "b0 AS (SELECT '' AS k, i, n, h FROM tops)",
        f"g0 AS (SELECT doc_id, '' AS k, i AS p, f, proof FROM f{levels} JOIN tops ON name = k)",
    ]
    for at in range(levels):
        parts += climb("b", "g", at)
    return f"""WITH {", ".join(parts)}
SELECT l.doc_id, l.leaf, t.h AS subroot, r.h AS root, sha256(g.proof) AS proof_sha256, g.f AS folded_root, g.f = r.h AS verified
FROM leaves l JOIN tops t ON t.name = l.k JOIN g{levels} g ON g.doc_id = l.doc_id CROSS JOIN b{levels} r"""


ORACLES["op13_merkle_manifest"] = _manifest_sql()


ORACLES["op8_minhash"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
bags AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM split),
sizes AS (SELECT doc_id, len(s) AS n FROM bags),
grams AS (SELECT doc_id, unnest(s) AS g FROM bags),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS met FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * met >= 85 * (a.n + b.n - met)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM sizes UNION SELECT r.doc_id, ways.y FROM reach r JOIN ways ON ways.x = r.other)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n"""
