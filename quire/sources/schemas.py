"""Schemas of the corpus and evidence records, and their value rules."""

from __future__ import annotations

from pyspark.sql import functions as F

PAGE = "requested_title string, title string, page_id long, revision_id long, revision_timestamp string, source_sha1 string, source_size long, content_model string, categories array<string>, role string, include_in_corpus boolean, raw_wikitext_path string, raw_sha256 string, parent_title string, scan_number int"
MANIFEST = f"id string, layer string, canon string, target_works array<string>, author string, title string, relationship array<string>, provider string, page_title string, pages array<struct<{PAGE.replace(' ', ':').replace(',:', ',')}>>"
BLOCK = "temporary_id string, work_id string, source_id string, layer string, canon string, target_works array<string>, source_page_title string, source_revision_id long, source_raw_sha256 string, volume string, section string, subsection string, speaker string, speaker_type string, text_source string"
PASSAGE = "id string, work_id string, source_id string, sequence long, text_traditional string, text_simplified string, text_search string, volume string, section string, subsection string, speaker string, speaker_type string, content_sha256 string, quality_flags array<string>, issue_counts map<string,long>, citation_allowed boolean, search_allowed boolean, previous_passage_id string, next_passage_id string, previous_citable_passage_id string, next_citable_passage_id string, correction_ids array<string>"
ALIAS = "alias string, canonical string, kind string, work_id string, target_work string, canon string"
EVIDENCE = "id string, source_id string, source_organization string, source_title string, url string, doi string, pmid string, publication_date date, verified_at date, expires_at date, status string, conclusion_direction string, directness string, evidence_type string, confidence string, summary_zh string, limitations_zh string, population_zh string, intervention_zh string, outcomes_zh string, source_content_sha256 string, topics array<struct<id:string,relevance:double>>"

# Enumerations of the stores.
CANONS = ("huangdi", "zhongjing", "nanjing", "wenbing")
LAYERS = ("core", "commentary", "lineage")
ALIAS_KINDS = ("work", "canon", "author", "term")


def work_rules() -> dict:
    return {"canon": F.col("canon").isin(*CANONS), "layer": F.col("layer").isin(*LAYERS), "id": F.col("id").isNotNull()}


def alias_rules() -> dict:
    return {"kind": F.col("kind").isin(*ALIAS_KINDS), "alias": F.length("alias") > 0}


def evidence_rules() -> dict:
    return {"url": F.startswith(F.col("url"), F.lit("https://")), "dates": F.col("expires_at") >= F.col("verified_at"), "topics": F.size("topics") > 0}
