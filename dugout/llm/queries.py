"""One query per operator over the driver's tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dugout.llm import bagminhash, bpe, decontaminate, divergence, html_crf, huffman, imatch, pii, quality, rankarray, revisits, secrets, spelling
from dugout.llm.common import ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    """Register a query; its operators' code is given to the workers first."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again: id count and digests of ids and bytes."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(coded, ranks))


@query
def op10_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids written as Huffman blocks and read back: place, count and checksum."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = huffman.store(table(spark, sf_dir, "documents"), tokenizer, end_id=1)
    return huffman.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all texts with their near words, their more frequent spelling and where that leads."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and the terms that set them apart."""
    return divergence.divergences(table(spark, sf_dir, "documents"))


@query
def op13_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded by the merges of a tokenizer definition: id count, digests of ids and text."""
    definition = public_tokenizers.path("byte_bpe_50k.json")
    coded = rankarray.encode(table(spark, sf_dir, "documents"), definition)
    return bpe.digests(rankarray.decode(coded, definition))


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id of its class of near copies."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark, with the item and how much of it."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_id")


@query
def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by a model fitted on a sample of the pages."""
    pages = table(spark, sf_dir, "pages")
    return html_crf.extract(pages, html_crf.fit_on(pages))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by rules learnt from the labels outside the held-out fifth."""
    documents = table(spark, sf_dir, "documents")
    rules = quality.fit_on(documents, table(spark, sf_dir, "labels"))
    found = quality.scored(documents.select("doc_id", "text"), rules)
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query
def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text, of the text with its second half replaced, and of the next text, compared."""
    documents = table(spark, sf_dir, "documents")
    return imatch.compared_in_order(documents, imatch.lexicon(documents), near=True)


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by a forest fitted on findings made from a sample."""
    documents = table(spark, sf_dir, "documents")
    return secrets.scan(documents, secrets.fit_on(documents))


@query
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    documents = table(spark, sf_dir, "documents")
    found = pii.detect(documents, pii.fit_on(documents))
    return found.select("doc_id", *[f"n_{k}" for k in pii.BASE_KINDS], F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every not-modified record of a crawl of the pages, with the response it confirms."""
    records = revisits.page_records(table(spark, sf_dir, "pages"))
    found = revisits.resolve(records, ("payload_digest", "payload_size"))
    names = ("etag", "cache-control", "content-type")
    headers = [F.try_element_at("headers", F.lit(n)).alias(n.replace("-", "_")) for n in names]
    return found.select("record_id", "uri", F.unix_seconds("date").alias("moment"), "response_id", "status", *headers, "payload_digest", "payload_size")


ORACLE["op5_revisits"] = r"""
with base as (
    select page_id, url, md5(coalesce(html, '')) as digest, length(coalesce(html, '')) as size,
           '"' || substr(md5(coalesce(html, '')), 1, 8) || '"' as tag,
           md5(md5(coalesce(html, '')) || '-2') as later,
           '"' || substr(md5(md5(coalesce(html, '')) || '-2'), 1, 8) || '"' as later_tag,
           page_id % 3 = 0 as changes,
           regexp_extract(url, '^([^:]+://[^/?#]*)', 1) || '/robots.txt' as robots,
           case when page_id % 2 = 0 then url || '#part'
                when contains(url, '?') or contains(url, '#') then url else url || '?utm_source=poll' end as spelled
    from pages
), records as (
    select page_id * 10 + k as record_id, k,
           (k = 0 or (k = 2 and changes) or (k = 5 and page_id % 50 = 0)) as full_response,
           case k when 1 then spelled when 5 then robots else url end as uri,
           1600000000 + page_id * 10 + case k when 1 then 100000 when 2 then 200000 when 3 then 300000 when 4 then -50 else 0 end as moment,
           case when k in (0, 1, 4) then tag when k = 2 and changes then later_tag when k = 2 then 'W/' || tag when k = 5 then '"robots"'
                when page_id % 5 = 0 then '"other"' when changes then later_tag else tag end as etag,
           'max-age=' || (k + 1) * 60 as cache_control, 'text/html; v=' || k as content_type,
           case k when 2 then later when 5 then md5(robots) else digest end as payload_digest, size as payload_size
    from base, range(6) r(k)
), parts as (
    select *, regexp_replace(trim(uri), '#.*$', '') as plain from records
), hosts as (
    select *,
           regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)), '^.*@', ''), '^www\.', ''), ':(80|443)?$', '') as host,
           regexp_extract(plain, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1) as path,
           array_to_string(list_sort(list_filter(string_split(regexp_extract(plain, '\?(.*)$', 1), '&'),
               lambda p: p <> '' and not regexp_matches(p, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))), '&') as params
    from parts
), sites as (
    select *, case when host <> '' then host || case when path = '' then '/' else path end || case when params = '' then '' else '?' || params end end as site
    from hosts
), responses as (
    select site, moment, max(record_id) as response_id from sites where full_response and site is not null group by site, moment
), found as (
    select v.*, r.response_id from (select * from sites where not full_response) v
    asof left join responses r on v.site = r.site and v.moment > r.moment
), both_sides as (
    select f.*, o.etag as old_etag, o.content_type as old_type, o.payload_digest as old_digest, o.payload_size as old_size,
           case when f.response_id is null then 'no response'
                when regexp_replace(o.etag, '^W/', '') = regexp_replace(f.etag, '^W/', '') then 'resolved' else 'changed' end as status
    from found f left join records o on o.record_id = f.response_id
)
select record_id, uri, moment, response_id, status,
       case when status = 'resolved' then etag end as etag,
       case when status = 'resolved' then cache_control end as cache_control,
       case when status = 'resolved' then old_type end as content_type,
       case when status = 'resolved' then old_digest end as payload_digest,
       case when status = 'resolved' then old_size end as payload_size
from both_sides
"""

ORACLE["op12_source_divergence"] = r"""
with docs as (
    select row_number() over () as row_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{80}-\x{10FFFF}]+') as terms
    from documents
), occurrences as (
    select lang, source, row_id, unnest(terms) as term from docs
), counted as (
    select lang, source, term, count(*) as n, count(distinct row_id) as docs from occurrences group by all
), kept as (
    select lang, term from counted group by all having sum(docs) >= 10
), sizes as (
    select d.lang, (select count(*) from kept k where k.lang = d.lang) as v from (select distinct lang from docs) d
), own as (
    select c.* from counted c join kept k on c.lang = k.lang and c.term = k.term
), groups as (
    select distinct lang, source from docs
), totals as (
    select g.lang, g.source, coalesce(sum(o.n), 0)::hugeint as total from groups g left join own o on g.lang = o.lang and g.source = o.source group by all
), shares as (
    select t.lang, t.source, k.term, coalesce(o.n, 0)::hugeint as n, 1 + (1000000000::hugeint * (coalesce(o.n, 0) + 2)) // (t.total + 2 * s.v) as p
    from totals t join sizes s on t.lang = s.lang join kept k on k.lang = t.lang
    left join own o on o.lang = t.lang and o.source = t.source and o.term = k.term
), lang_shares as (
    select k.lang, k.term, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (t.total + 2 * s.v) as q
    from kept k join sizes s on k.lang = s.lang
    join (select lang, sum(total)::hugeint as total from totals group by lang) t on t.lang = k.lang
    join (select lang, term, sum(n)::hugeint as n from own group by all) c on c.lang = k.lang and c.term = k.term
), pairs as (
    select a.lang, a.source, b.source as item,
           coalesce((select sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) from shares x join shares y on x.lang = y.lang and x.term = y.term
                     where x.lang = a.lang and x.source = a.source and y.source = b.source), 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
), terms as (
    select x.lang, x.source, x.term as item, (((x.p - l.q) * (x.p - l.q)) // (x.p + l.q))::bigint as value
    from shares x join lang_shares l on x.lang = l.lang and x.term = l.term where x.n > 0 and x.p > l.q
), listed as (
    select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms
), ranked as (
    select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from listed
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 10
"""
