"""One query for each operator with production parameters over its whole table, and SQL for those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import read
from plumbline.llm.exact_dedup import exact_dedup
from plumbline.llm.license_digest import COPYRIGHT_LINE, NOT_WORD, PHRASES, RESERVED_LINE, SPELLINGS, scan
from plumbline.llm.license_texts import KNOWN
from plumbline.llm.mixing import mix
from plumbline.llm.near_dedup import near_duplicates
from plumbline.llm.packing import pack
from plumbline.llm.quality_rules import judge
from plumbline.llm.suffix_dedup import remove_repeats
from plumbline.llm.toxicity import fit, held_out, score
from plumbline.llm.url_filter import filter_urls
from plumbline.llm.warc_audit import audit, warc_record


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels").filter(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


#: Pages in a file of the audited archive, and the bytes that each has there.
PAGES_A_FILE, SLOT = 512, 1 << 20


def op4_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records at their byte offsets in files of 512, against a replica with known damage: some records
    lost, some with a byte more, some written twice. Returns what differs, with the page of that place."""
    pages = read(spark, sf_dir, "pages")
    file = F.concat(F.lit("pages-"), F.lpad(F.expr(f"page_id div {PAGES_A_FILE}").cast("string"), 8, "0"), F.lit(".warc")).alias("file")
    at = F.col("page_id") % PAGES_A_FILE * SLOT
    worn = F.when(F.col("page_id") % 89 == 7, F.concat(F.coalesce("html", F.lit("")), F.lit("?"))).otherwise(F.col("html"))
    primary = pages.select(file, at.alias("offset"), warc_record(F.col("url"), F.col("html")).alias("record"))
    left = pages.filter(F.coalesce(F.col("page_id") % 97 != 3, F.lit(True)))
    twice = F.explode(F.when(F.col("page_id") % 101 == 5, F.array(at, at + 1)).otherwise(F.array(at))).alias("offset")
    replica = left.select(file, twice, warc_record(F.col("url"), worn).alias("record"))
    page = F.expr(f"cast(substring(file, 7, 8) as bigint) * {PAGES_A_FILE} + offset div {SLOT}")
    return audit(primary, replica).select(F.when(F.col("file") != "", page).alias("page_id"), "file", "offset", "status", "primary_sha256", "replica_sha256")


def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_chosen_path_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_compression_toxicity, op2_power_of_two_packing, op3_exact_dedup, op4_merkle_fixity, op5_robust_outliers, op6_license_digests, op7_suffix_array_dedup, op8_url_rules, op9_source_mixing, op10_chosen_path_near_dedup)}


def _warc_sql(body: str) -> str:
    return rf"""concat('WARC/1.1', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Target-URI: ', coalesce(url, ''), chr(13), chr(10),
        'Content-Type: text/html', chr(13), chr(10), 'Content-Length: ', strlen({body}), chr(13), chr(10), chr(13), chr(10), {body}, chr(13), chr(10), chr(13), chr(10))"""


def _licence_words(text: str) -> str:
    """The canonical text in SQL."""
    bare = rf"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({text}, '')), '\r\n?', chr(10), 'g'),
                '{COPYRIGHT_LINE}', ' ', 'g'), '{RESERVED_LINE}', ' ', 'g'), '{NOT_WORD}', ' ', 'g'))"""
    out = f"' ' || array_to_string(list_transform(string_split({bare}, ' '), lambda w: coalesce({_SPELLINGS_SQL}[w], w)), '  ') || ' '"
    for phrase, one in PHRASES.items():
        out = f"replace({out}, ' {phrase.replace(' ', '  ')} ', ' {one.replace(' ', '  ')} ')"
    return f"trim(replace({out}, '  ', ' '))"


_SPELLINGS_SQL = "map {" + ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS.items()) + "}"

ORACLE_SQL = {
    "op4_merkle_fixity": f"""
        WITH placed AS (
            SELECT *, 'pages-' || lpad(CAST(page_id // {PAGES_A_FILE} AS VARCHAR), 8, '0') || '.warc' AS file, page_id % {PAGES_A_FILE} * {SLOT} AS place,
                   {_warc_sql("coalesce(html, '')")} AS r, {_warc_sql("concat(coalesce(html, ''), '?')")} AS worn FROM pages)
        SELECT page_id, file, place AS "offset", CASE WHEN page_id % 97 = 3 THEN 'missing' ELSE 'corrupt' END AS status, sha256(r) AS primary_sha256,
               CASE WHEN page_id % 97 <> 3 THEN sha256(worn) END AS replica_sha256
        FROM placed WHERE page_id % 97 = 3 OR page_id % 89 = 7
        UNION ALL
        SELECT page_id, file, place + 1, 'extra', NULL, sha256(CASE WHEN page_id % 89 = 7 THEN worn ELSE r END) FROM placed WHERE page_id % 101 = 5 AND page_id % 97 <> 3""",
    "op6_license_digests": f"""
        WITH texts(license, text) AS (VALUES {", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in KNOWN.items())}),
        known AS (SELECT sha256({_licence_words("text")}) AS digest, min(license) AS license FROM texts GROUP BY 1),
        own AS (SELECT doc_id, sha256({_licence_words("text")}) AS digest FROM documents)
        SELECT doc_id, own.digest, license FROM own LEFT JOIN known ON own.digest = known.digest""",
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op8_url_rules": r"""
        WITH parts AS (
            SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        cut AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
            FROM cut)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN regexp_matches(host, '(^|[.-])(spam|casino|xxx)([.-].*)?$') OR regexp_matches(host, '(^|[.-])(cheap|buy|online)-pills\..*$') THEN 'block'
            WHEN regexp_matches(path, '^(/[^/]*)*/track/click(/|$)') OR regexp_matches(path, '^(/[^/]*)*/adserver(/|$)') THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled""",
    "op10_chosen_path_near_dedup": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s FROM worded),
        items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reach(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id, s.doc_id = r.component_id AS kept
        FROM sets s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON s.doc_id = r.a""",
    "op7_suffix_array_dedup": """
        WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        w AS (SELECT rid, doc_id, i, substr(h, CAST(2 * i + 1 AS BIGINT), 100) AS s FROM (SELECT *, unnest(range(0, len(h) // 2 - 49)) AS i FROM d)),
        f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
        marked AS (SELECT rid, i FROM w JOIN f USING (s) WHERE doc_id > m),
        islands AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS run FROM (
            SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM marked)),
        runs AS (SELECT rid, min(i) AS s, max(i) + 50 AS e FROM islands GROUP BY rid, run),
        edges AS (SELECT rid, s, e FROM runs UNION ALL SELECT rid, len(h) // 2, len(h) // 2 FROM d),
        pieces AS (SELECT rid, s, e, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY s, e), 0) AS p FROM edges),
        kept AS (
            SELECT d.rid, any_value(d.doc_id) AS doc_id, CAST(any_value(len(h)) // 2 AS BIGINT) AS n_bytes, CAST(sum(e - s) AS BIGINT) AS n_removed,
                   CAST(count(*) - 1 AS BIGINT) AS n_spans, string_agg(substr(h, CAST(2 * p + 1 AS BIGINT), CAST(2 * (s - p) AS BIGINT)), '' ORDER BY s, e) AS k
            FROM d JOIN pieces USING (rid) GROUP BY d.rid)
        SELECT doc_id, n_bytes, n_removed, n_spans, sha256(unhex(k)) AS kept_sha256 FROM kept""",
}
