"""The thirteen operators over the given tables, each with its production parameters."""

from __future__ import annotations

import public_tokenizers

from cohortline.llm import (
    alignment, byte_pairs, hash_ring, licenses, mixing, near_duplicates, ordinal_quality, personal_data, secrets, spelling,
    top_k, url_rules, winnowing,
)
from cohortline.llm.inputs import table
from cohortline.llm.registry import query


@query("op1_licenses")
def op1_licenses(spark, folder):
    return licenses.license_findings(table(spark, folder, "documents"))


@query("op2_winnowing")
def op2_winnowing(spark, folder):
    return winnowing.fingerprints(table(spark, folder, "documents"))


@query("op3_secrets")
def op3_secrets(spark, folder):
    return secrets.secret_findings(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op4_top_k")
def op4_top_k(spark, folder):
    return top_k.top_k(table(spark, folder, "embeddings"), k=5, every=50)


@query("op5_near_duplicates")
def op5_near_duplicates(spark, folder):
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), percent=85)


@query("op6_url_rules", sql="""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/'))
SELECT page_id, p.host AS host, p.path AS path,
       (SELECT arg_max(r.host || r.path, length(r.host || r.path)) FROM rules r
        WHERE (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS rule,
       coalesce((SELECT arg_max(r.verdict, length(r.host || r.path)) FROM rules r
        WHERE (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path)), 'allow') AS verdict
FROM parts p""")
def op6_url_rules(spark, folder):
    return url_rules.judged(table(spark, folder, "pages"), url_rules.rule_frame(spark))


@query("op7_ordinal_quality")
def op7_ordinal_quality(spark, folder):
    return ordinal_quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_personal_data")
def op8_personal_data(spark, folder):
    return personal_data.digests(table(spark, folder, "documents"))


@query("op9_byte_pairs")
def op9_byte_pairs(spark, folder):
    return byte_pairs.round_trips(table(spark, folder, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op10_mixture")
def op10_mixture(spark, folder):
    return mixing.mixture_sizes(table(spark, folder, "documents"))


@query("op11_hash_ring")
def op11_hash_ring(spark, folder):
    return hash_ring.sharded(table(spark, folder, "documents"), 24).drop("home")


@query("op12_alignment")
def op12_alignment(spark, folder):
    return alignment.aligned(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))


@query("op13_spelling")
def op13_spelling(spark, folder):
    return spelling.spelling_variants(table(spark, folder, "documents"))
