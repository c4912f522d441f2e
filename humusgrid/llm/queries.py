"""Queries of the problems over text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from humusgrid.llm.bpe import encode_corpus
from humusgrid.llm.forms import canonical_text, look_alike_pairs, look_classes
from humusgrid.llm.leaks import leaked_items
from humusgrid.llm.scans import noisy_texts, repaired_texts
from humusgrid.llm.subjects import document_subjects
from humusgrid.llm.survivor import consensus_sources, field_sources, trust_rank
from humusgrid.operators.components import connected_components
from humusgrid.session import cut_lineage
from humusgrid.sources.tables import load_table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = look_alike_pairs(load_table(spark, sf_dir, "document"), "document_id", "title")
    labels = look_alike_pairs(load_table(spark, sf_dir, "profile"), "profile_id", "profile_label", "site_id")
    return titles.select(F.lit("document.title").alias("field"), "id_a", "id_b").unionByName(labels.select(F.lit("profile.profile_label").alias("field"), "id_a", "id_b"))


def p1_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title and label in one form, its form to compare by, and the representative of the texts that print like it."""
    out = None
    for name, table, id_col, text_col in (("document.title", "document", "document_id", "title"), ("profile.profile_label", "profile", "profile_id", "profile_label")):
        rows = look_classes(load_table(spark, sf_dir, table), id_col, text_col)
        part = rows.select(F.lit(name).alias("field"), F.col("id").alias("row_id"), "one_form", canonical_text(F.col("one_form")).alias("compare_form"), "class_id", "texts")
        out = part if out is None else out.unionByName(part)
    return out


def scanned_fields(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame, str, str]]:
    return [
        ("extraction.raw_text", load_table(spark, sf_dir, "extraction"), "extraction_id", "raw_text"),
        ("location_candidate.context_text", load_table(spark, sf_dir, "location_candidate"), "candidate_id", "context_text"),
        ("profile_evidence.evidence_text", load_table(spark, sf_dir, "profile_evidence"), "evidence_id", "evidence_text"),
    ]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noisy_texts(scanned_fields(spark, sf_dir))


def p2_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_texts(scanned_fields(spark, sf_dir))


# Fields and trust orders of the two kinds of records.
PROFILE_FIELDS = ("author_soil_type_raw", "author_profile_formula_raw", "soil_classification", "classification_system", "land_use")
SITE_FIELDS = ("name", "region", "spatial_precision_m", "publication_year")
PROFILE_TRUST = ("accepted", "unreviewed", "flagged")
SITE_TRUST = ("exact", "reported", "geocoded", "regional_only", "unverified")


def merge_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, id, group_id) of both merge logs; one graph, whose parts never touch."""

    def edges(entity: str) -> DataFrame:
        log = load_table(spark, sf_dir, f"{entity}_merge")
        # the entity before the id keeps the order of ids within an entity
        return log.select(*[F.concat(F.lit(f"{entity}\n"), F.col(f"{side}_{entity}_id")).alias(side) for side in ("retired", "canonical")])

    found = connected_components(edges("profile").unionByName(edges("site")), "retired", "canonical")
    cut = lambda c: F.substring_index(c, "\n", 1), lambda c: F.expr(f"substring({c}, instr({c}, '\n') + 1)")
    return found.select(cut[0](F.col("id")).alias("entity"), cut[1]("id").alias("id"), cut[1]("component").alias("group_id"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = cut_lineage(merge_groups(spark, sf_dir), "groups")
    parts = []
    for entity, table, fields, trust in (
        ("profile", "profile", PROFILE_FIELDS, trust_rank(F.col("review_status"), PROFILE_TRUST)),
        ("site", "reported_site", SITE_FIELDS, trust_rank(F.col("spatial_confidence"), SITE_TRUST)),
    ):
        members = groups.filter(F.col("entity") == entity).select("id", "group_id")
        found = field_sources(members, load_table(spark, sf_dir, table), f"{entity}_id", fields, trust, "updated_at")
        parts.append(found.select(F.lit(entity).alias("entity"), "group_id", "field_name", "source_id"))
    profiles = groups.filter("entity = 'profile'").select("id", "group_id")
    # evidence belongs to the group of its canonical profile, else of its retired one
    moved = load_table(spark, sf_dir, "profile_merge_evidence").select("canonical_profile_id", "retired_profile_id", F.col("merge_evidence_id").alias("id"), F.col("evidence_text").alias("text"))
    sides = F.array(*[F.struct(F.lit(k).alias("rank"), F.col(f"{c}_profile_id").alias("profile")) for k, c in enumerate(("canonical", "retired"))])
    held = moved.select("id", "text", F.explode(sides).alias("side")).select("id", "text", "side.rank", "side.profile").join(profiles.withColumnRenamed("id", "profile"), "profile")
    told = held.groupBy("id", "text").agg(F.min(F.struct("rank", "group_id"))["group_id"].alias("group_id"))
    texts = consensus_sources(told).select(F.lit("profile").alias("entity"), "group_id", F.lit("evidence_text").alias("field_name"), "source_id")
    return parts[0].unionByName(parts[1]).unionByName(texts)


def public_vocabulary(name: str) -> tuple[str, str]:
    """Path of a public tokenizer's file and its pattern."""
    import public_tokenizers

    return str(public_tokenizers.path(name)), public_tokenizers.PATTERN


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary, pattern = public_vocabulary("byte_bpe_50k.tiktoken")
    return encode_corpus(load_table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary, pattern)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "eval_items"), "doc_id", "item_id").select("doc_id", "item_id")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_subjects(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "subjects"), load_table(spark, sf_dir, "doc_labels")).select("doc_id", "subject")


QUERIES = {"p1_found": p1_found, "p1_forms": p1_forms, "p2_found": p2_found, "p2_repaired": p2_repaired, "p6_found": p6_found, "p7_ids": p7_ids, "p8_found": p8_found, "p9_found": p9_found}
ORACLE: dict[str, str] = {}
