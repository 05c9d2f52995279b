"""One query for each operator, over its whole table, and the SQL of those that SQL can express.

The operators return texts, spans, ids and files; the digests of the result contracts are made here.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from jobmart.llm import bpe, decontam, hard_negatives, html_text, merkle, ngram_trie, packing, quality, repeats, simhash, token_counts, token_files, url_rules
from jobmart.llm.common import scratch, table

URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return token_files.read(spark, out, ids=False)


def op2_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.scores(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spaces = F.regexp_replace(F.coalesce("kept", F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return repeats.remove(docs, more_text=False).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.regexp_replace(spaces, "^ | $", "").cast("binary"), 256).alias("kept_sha256"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.fit(pages)).select("page_id", "url", "text", "n_chars")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    urls = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(urls, rules).select("page_id", "host", "path", "rule", "verdict")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.broadcast(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.encode(docs, vocabulary, decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.item_id", "m.start", "m.stop", "m.edits")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = simhash.classes(table(spark, sf_dir, "documents"))
    return named.select("doc_id", simhash.hex64("fingerprint").alias("fingerprint"), "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof and check of each document; of a third of them a changed text is checked."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.digest(*map(F.col, fields[:4]), lower))
    tree = merkle.manifest(docs, fields, tree="lang", key="doc_id", claim=changed)
    digests = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
    return merkle.proofs(tree, siblings=False).select(F.col("id").alias("doc_id"), *digests, "verified")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten negatives of each of five positives; anchors are the ids divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepare(vectors, "vec_id", label, "embedding", scale=256)
    return hard_negatives.mine(rows, F.col("id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


def op13_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1, window=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {f.__name__: f for f in (op1_token_files, op2_ngram_trie, op3_substring_dedup, op4_html_text, op5_url_rules, op6_byte_bpe,
                                   op7_token_counts, op8_quality_rules, op9_decontamination, op10_simhash, op11_merkle_manifest, op12_hard_negatives, op13_lexical_packing)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLES = {
    "op3_substring_dedup": r"""
        with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        windows as (select doc_id, s, md5(array_to_string(list_slice(w, s, s + 34), ' ')) as h
                    from words, unnest(range(1, len(w) - 33)) as t(s)),
        repeated as (select doc_id, s from (select doc_id, s, count(*) over (partition by h) as c from windows) where c > 1),
        gone as (select distinct doc_id, s + k as i from repeated, range(35) as t(k)),
        each as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from words),
        kept as (select doc_id, string_agg(word, ' ' order by i) as text from each anti join gone using (doc_id, i) group by doc_id),
        lost as (select doc_id, count(*) as n from gone group by doc_id)
        select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
        from words left join lost using (doc_id) left join kept using (doc_id)""",
    "op5_url_rules": r"""
        with parts as (select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                              coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
        rules(rh, rp, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        best as (select page_id, arg_max(rh || rp, length(rh || rp)) as rule, arg_max(verdict, length(rh || rp)) as verdict
                 from parts join rules on (host = rh or host like '%.' || rh) and starts_with(path, rp) group by page_id)
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join best using (page_id)""",
    "op11_merkle_manifest": r"""
        with recursive
        crc as (select list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)),
                       lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
        told as (select *, case when text is null then '-' else strlen(text) || ':' || text end as said,
                        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered,
                        coalesce(length(doc_id::varchar) || ':' || doc_id, '-')
                        || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                        || coalesce(length(n_chars::varchar) || ':' || n_chars, '-') as head,
                        xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda d: ascii(d)::bigint)),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 3 = 0 as tampered
                 from documents, crc),
        leaves as (select doc_id, lang, sha256(head || said) as leaf,
                          case when tampered and text is not null then sha256(head || strlen(lowered) || ':' || lowered)
                               else sha256(head || said) end as claim from told),
        placed as (select *, row_number() over (partition by lang order by doc_id) - 1 as place, count(*) over (partition by lang) as n from leaves),
        trees as (select lang, 0 as depth, place as i, leaf as h, n from placed
                  union all
                  select lang, depth + 1, i // 8, sha256(string_agg(h, '' order by i)), (max(n) + 7) // 8 from trees where n > 1 group by lang, depth, i // 8),
        roots as (select lang, h as subroot, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as n from trees where n = 1),
        top as (select 0 as depth, place as i, subroot as h, n from roots
                union all
                select depth + 1, i // 8, sha256(string_agg(h, '' order by i)), (max(n) + 7) // 8 from top where n > 1 group by depth, i // 8),
        nodes as (select lang, depth, i, n, false as above, h from trees union all select null, depth, i, n, true, h from top),
        runs as (select *, coalesce(string_agg(h, '') over (w rows between unbounded preceding and 1 preceding), '') as pre,
                        coalesce(string_agg(h, '') over (w rows between 1 following and unbounded following), '') as post
                 from nodes where n > 1 window w as (partition by above, lang, depth, i // 8 order by i)),
        folded as (select doc_id, p.lang, false as above, 0 as depth, p.place as i, claim as h, '' as proof, p.n, r.place as up
                   from placed p join roots r on p.lang is not distinct from r.lang
                   union all
                   select doc_id, f.lang, case when f.n = 1 then true else f.above end,
                          case when f.n = 1 then 0 else f.depth + 1 end, case when f.n = 1 then up else f.i // 8 end,
                          case when f.n = 1 then f.h else sha256(pre || f.h || post) end, case when f.n = 1 then proof else proof || pre || post end,
                          case when f.n = 1 then (select max(n) from roots) else (f.n + 7) // 8 end, up
                   from folded f left join runs r on f.n > 1 and r.above = f.above and r.depth = f.depth and r.i = f.i
                                                     and (f.above or r.lang is not distinct from f.lang)
                   where not (f.above and f.n = 1)),
        done as (select * from folded where above and n = 1)
        select d.doc_id, leaf, subroot, (select h from top where n = 1) as root, sha256(proof) as proof_sha256, d.h as folded_root,
               d.h = (select h from top where n = 1) as verified
        from done d join leaves l using (doc_id) join roots r on d.lang is not distinct from r.lang""",
    "op12_hard_negatives": """
        with kept as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                             list_transform(embedding, lambda x: floor(256 * x::double)) as q
                      from embeddings where vec_id is not null and label is not null and embedding is not null
                                            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
                   from kept a join kept b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
        positives as (select * from scored where same
                      qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
        select p.anchor_id, p.other as positive_id, row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other)::int as rank,
               n.other as negative_id, p.score as positive_score, n.score as negative_score
        from positives p join scored n on p.anchor_id = n.anchor_id and not n.same and 100 * n.score between 30 * p.score and 90 * p.score
        qualify rank <= 10""",
}
