"""Registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.llm import (align, exact, license, lines, mixing, near, quality, resample,
                          secrets, simhash, spm, tokenbin, warc)
from reelrank.llm.common import documents
from reelrank.session import scratch_path
from reelrank.sources.tables import read_table

WORD_VOCABULARY, WORD_END = 49408, 2


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file; none of them is part of this repository.

    ``RECS_TOKENIZERS`` names another folder for them.
    """
    folder = os.environ.get("RECS_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written and read back.

    Responses are read with their payload, which is measured and hashed anew;
    revisits by a pushed type filter and headers only.
    """
    path = scratch_path(spark, "op1-archives")
    warc.write_warc(warc.page_records(read_table(spark, sf_dir, "pages")), path)
    def page(name: str) -> Column:  # null for a page without id
        return F.regexp_extract(name, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")

    full = warc.read_warc(spark, path, ["warc_type", "record_id", "payload"])
    full = full.where("warc_type = 'response'").select(
        page("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        F.col("warc_type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    again = warc.read_warc(spark, path, ["warc_type", "record_id", "refers_to", "payload_digest",
                                         "payload_length"])
    again = again.where("warc_type = 'revisit'").select(
        page("record_id").alias("page_id"), F.col("payload_length").alias("payload_bytes"),
        F.expr("substring(payload_digest, length('sha256:') + 1)").alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"))
    return full.unionByName(again)


OP1_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
h as (select page_id, octet_length(b) as n, sha256(b) as d from p),
g as (select d, min(page_id) as first from h where n >= 100 group by d)
select h.page_id, cast(h.n as bigint) as payload_bytes, h.d as payload_digest,
       case when g.first < h.page_id then 'revisit' else 'response' end as record_type,
       case when g.first < h.page_id then g.first end as refers_to
from h left join g on h.d = g.d and h.n >= 100
"""


MIX_TEMPERATURE, MIX_SEED = 0.5, 17


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed so that a source's share follows sqrt(its rows)."""
    mixed = mixing.mix_sources(documents(spark, sf_dir), temperature=MIX_TEMPERATURE,
                               seed=MIX_SEED, details=True)
    return mixed.select("doc_id", "source", F.round("rate", 9).alias("rate"), "n_copies", "copy",
                        "text")


OP2_SQL = f"""
with c as (select source, count(*) as n from documents group by source),
w as (select source, n, power(n, {MIX_TEMPERATURE}) as w from c),
r as (select source, w / sum(w) over () * cast(sum(n) over () as double) / n as rate from w),
k as (select source, rate, unnest(generate_series(0, cast(ceil(rate + 12 * sqrt(rate) + 20)
      as bigint))) as k from r),
p as (select source, rate, k,
      sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) over (partition by source order by k) as cdf
      from k),
d as (select doc_id, source, text, cast(cast('0x' || substr(md5({MIX_SEED} || '|' ||
      coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, ''))), 1, 13) as bigint)
      as double) / 4503599627370496.0 as u from documents),
t as (select d.doc_id, d.source, d.text, any_value(p.rate) as rate, count(*) as n_copies
      from d join p on p.source is not distinct from d.source and p.cdf <= d.u
      group by d.doc_id, d.source, d.text)
select doc_id, source, round(rate, 9) as rate, n_copies,
       unnest(generate_series(0, n_copies - 1)) as copy, text from t
"""


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed token ids, written and read back."""
    path = scratch_path(spark, "op3-ids")
    tokenbin.write_packed(documents(spark, sf_dir), path, WORD_VOCABULARY,
                          tokenizer_file("word_bpe_49k.json"), WORD_END)
    return tokenbin.read_packed(spark, path, ["doc_id", "start", "n_tokens", "ids_crc32"])


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(documents(spark, sf_dir))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the class of near-duplicates they belong to."""
    out = near.near_classes(documents(spark, sf_dir))
    return out.select(F.col("row.id").alias("doc_id"), F.col("class_row.id").alias("class_id"),
                      "class_size", "links",
                      F.expr("row <=> class_row").alias("kept"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(documents(spark, sf_dir))


OP6_SQL = """
with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id,
       count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from t
"""


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    out = quality.quality_verdicts(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of the secrets of all documents."""
    out = secrets.scan_secrets(documents(spark, sf_dir))

    def count(kind: str):
        at = secrets.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == at)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", count("assign"), count("access"), count("hex"),
                      F.sha2(secrets.span_text("base"), 256).alias("base_sha256"),
                      secrets.span_text("spans").alias("spans"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated three-line windows, as counts and digests."""
    out = lines.dedup_lines(documents(spark, sf_dir), details=True)
    return out.select("doc_id", "n_lines", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP9_SQL = r"""
with d as (select doc_id, string_split(text, chr(10)) as l from documents),
x as (select doc_id, generate_subscripts(l, 1) as i, unnest(l) as line from d),
s as (select doc_id, i, line, row_number() over (partition by doc_id order by i) as k,
             count(*) over (partition by doc_id) as n
      from x where regexp_matches(line, '[^\t-\r ]')),
w as (select doc_id, k, least(n, 3) as size, line as a,
             lead(line, 1) over (partition by doc_id order by k) as b,
             lead(line, 2) over (partition by doc_id order by k) as c, n from s),
v as (select doc_id, k, size, a, case when size > 1 then b end as b,
             case when size > 2 then c end as c from w where k <= greatest(1, n - 2)),
o as (select doc_id, k, row_number() over (partition by size, a, b, c order by doc_id, k) as nth
      from v),
g as (select distinct s.doc_id, s.i from s join o on o.doc_id = s.doc_id and o.nth > 1
      and s.k between o.k and o.k + 2),
r as (select x.doc_id, count(*) as n_lines, count(g.i) as n_removed,
             string_agg(x.line, chr(10) order by x.i) filter (where g.i is null) as t
      from x left join g on g.doc_id = x.doc_id and g.i = x.i group by x.doc_id)
select d.doc_id, coalesce(r.n_lines, 0) as n_lines, coalesce(r.n_removed, 0) as n_removed,
       sha256(coalesce(r.t, '')) as text_sha256
from documents d left join r on r.doc_id = d.doc_id
"""


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to piece ids and decoded again."""
    out = spm.round_trips(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))
    return out.select(F.col("id").alias("doc_id"), "n_pieces", "n_bytes", "ids_crc32",
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with weight and score towards ``benchmark``; 5 % of them ranked."""
    out = resample.importance_draw(documents(spark, sf_dir),
                                   read_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with fingerprint and component."""
    out = simhash.simhash_components(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "fingerprint", "component_id",
                      "component_size")


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned under a byte-level BPE and a SentencePiece model."""
    found = align.Alignment(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"),
                            tokenizer_file("piece_bpe_32k.model"))
    return found.documents().withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_mix": op2_mix,
    "op3_token_ids": op3_token_ids,
    "op4_licenses": op4_licenses,
    "op5_near_dedup": op5_near_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_line_dedup": op9_line_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_resample": op11_resample,
    "op12_simhash": op12_simhash,
    "op13_align": op13_align,
}
ORACLES = {
    "op1_warc": OP1_SQL,
    "op2_mix": OP2_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op9_line_dedup": OP9_SQL,
}
