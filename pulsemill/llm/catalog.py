"""The queries of this subpackage; those that SQL can express have a twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.shared import ready, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(make: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return make(ready(spark), folder)

    QUERIES[make.__name__] = run
    return make


@query
def op1_grouping_pack(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.packing import pack, token_pieces

    pieces = token_pieces(tables(spark, folder, "documents"), tokenizer_path(WORD_FILE))
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_scaled_sketch(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.sketch import fingerprint_report

    return fingerprint_report(tables(spark, folder, "documents"))


@query
def op3_piece_codec(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.codec import encode_documents

    return encode_documents(tables(spark, folder, "documents"), tokenizer_path(PIECE_FILE))


@query
def op10_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.windows import drop_repeated_lines

    docs = drop_repeated_lines(tables(spark, folder, "documents"))
    return docs.select("doc_id", "text", "n_removed")


@query
def op4_norm_sorted_topk(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.topk import exact_top_k

    return exact_top_k(tables(spark, folder, "embeddings"), F.col("id") % 50 == 0)


ORACLES["op4_norm_sorted_topk"] = """
with ints as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from ints q join ints c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.pages import extract_main_text

    return extract_main_text(tables(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op5_weighted_minhash(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.neardup import near_duplicates

    found = near_duplicates(tables(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "class_id", "class_size", "keep")


@query
def op6_language_fusion(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by their text, label and source; pages also by markup, address and host."""
    from pulsemill.llm.languages import fit_trigrams, identify

    docs, pages = tables(spark, folder, "documents"), tables(spark, folder, "pages")
    model = fit_trigrams(docs)
    of_docs = identify(docs, model, declared=F.col("lang"), host=F.col("source"))
    shown = pages.select(
        "page_id",
        "url",
        F.regexp_replace("html", r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<[^>]*>", " ").alias("text"),
        F.regexp_extract("html", r"(?i)<html[^>]*\blang=[\"']?([a-z-]+)", 1).alias("declared"),
    )
    of_pages = identify(
        shown,
        model,
        declared=F.col("declared"),
        segment=F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})(?:[/?#]|$)", 1),
        host=F.nullif(F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1), F.lit("")),
    )
    found = ["language", "confidence", "accepted"]
    return of_docs.select("doc_id", *found).unionByName(of_pages.select("page_id", *found), allowMissingColumns=True)


@query
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.secret_scan import secret_report

    return secret_report(tables(spark, folder, "documents"))


@query
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.personal import personal_report

    return personal_report(tables(spark, folder, "documents"))


# Address rules: verdict, host and the start of the path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query
def op12_filter_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Listed are the addresses that no rule fits on hosts with more blocked than allowed addresses."""
    from pulsemill.llm.cascade import build_cascade, filter_addresses, keys_of_blocked_hosts

    pages = tables(spark, folder, "pages").select("page_id", "url")
    cascade = build_cascade(*keys_of_blocked_hosts(pages, RULES))
    return filter_addresses(pages, RULES, cascade).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op12_filter_cascade"] = r"""
with split as (
  select page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host
  from pages
), ruled as (
  select *, case
    when ('.' || host) like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
    when ('.' || host) like '%.example.org' and starts_with(path, '/es/') then 'example.org/es/'
    when ('.' || host) like '%.com' and starts_with(path, '/fr/') then 'com/fr/'
    when ('.' || host) like '%.com' and starts_with(path, '/de/') then 'com/de/'
    when ('.' || host) like '%.org' and starts_with(path, '/') then 'org/'
  end as rule
  from split
), said as (
  select *, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block' end as says from ruled
), bad as (
  select host from (select distinct host, path, says from said)
  group by host having count(*) filter (says = 'block') > count(*) filter (says = 'allow')
)
select page_id, host, path, rule,
  coalesce(says, case when host in (select host from bad) then 'block' else 'allow' end) as verdict
from said
"""


@query
def op11_token_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    from pulsemill.llm.alignment import align

    return align(tables(spark, folder, "documents"), tokenizer_path(BYTE_FILE), tokenizer_path(PIECE_FILE))


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of the documents, of which a tenth is given a periodic end."""
    from pulsemill.llm.periodic import find_runs, made_periodic, run_report

    docs = tables(spark, folder, "documents")
    return run_report(find_runs(docs.select("doc_id", made_periodic(F.col("text"), F.col("doc_id")).alias("text"))))
