"""Checks: completeness of chunks, documents and model answers against their rules, with reasons instead of exceptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import lenient_date

#: Fixed values.
PURPOSES = (
    "Background/Context", "Drug/Therapy Description", "Clinical Trial Design", "Efficacy Results", "Safety/Adverse Events", "Pharmacoeconomic Analysis",
    "Dosage and Administration", "Regulatory History", "PBAC Recommendation", "Sponsor's Justification", "Stakeholder Commentary", "Miscellaneous",
)
ENTITY_TYPES = ("DRUG", "THERAPEUTIC_CLASS", "TRIAL_ACRONYM", "SPONSOR", "INDICATION", "MECHANISM_OF_ACTION", "ENDPOINT", "REGULATORY_BODY")
PERSONAS = ("clinical_analyst", "health_economist", "regulatory_specialist")
REQUIRED = ("title", "sections", "doc_id")


#: Of a model's answer about a chunk.
PAYLOAD = "semantic_purpose struct<value:string,confidence:double,justification:string>, persona_relevance_scores map<string,struct<score:double,justification:string>>, typed_entities array<struct<name:string,type:string>>, quality_assessment struct<confidence:double,is_ambiguous:boolean,justification:string>"


def completeness(source: DataFrame, chunks: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Characters of chunks against characters of the source: (doc_id, source_chars, chunk_chars, ratio, status). Both sides: doc_id, text."""
    a = source.groupBy("doc_id").agg(F.sum(F.length("text")).alias("source_chars"))
    b = chunks.groupBy("doc_id").agg(F.sum(F.length("text")).alias("chunk_chars"))
    j = a.join(b, "doc_id", "full").na.fill(0, ["source_chars", "chunk_chars"])
    ratio = F.try_divide(F.col("chunk_chars"), F.col("source_chars"))
    status = F.when(F.col("source_chars") == 0, F.when(F.col("chunk_chars") == 0, "passed").otherwise("skipped")).when(ratio >= threshold, "passed").otherwise("failed")
    return j.select("doc_id", "source_chars", "chunk_chars", ratio.alias("ratio"), status.alias("status"))


def content_completeness(blocks: DataFrame, tables: DataFrame, chunks: DataFrame, threshold: float = 0.95) -> DataFrame:
    """completeness() of a document with tables: its text blocks and its tables' markdown against semantic_text chunks and raw table contents.

    blocks: doc_id, text, block_type; tables: doc_id, markdown; chunks: doc_id, chunk_type, text, raw_table_content.
    """
    source = blocks.filter("block_type = 'text'").select("doc_id", "text").unionByName(tables.select("doc_id", F.coalesce("markdown", F.lit("")).alias("text")))
    kept = F.when(F.col("chunk_type") == "semantic_text", F.col("text")).when(F.col("chunk_type") == "table_summary", F.coalesce("raw_table_content", F.lit(""))).otherwise("")
    return completeness(source, chunks.select("doc_id", kept.alias("text")), threshold)


def validate_docs(docs: DataFrame) -> DataFrame:
    """Adds status, errors and warnings, and the meeting date as ISO. docs: title, sections array<struct<heading,...>>, pbac_meeting_date, doc_id.

    The first missing required field is the only error, and then nothing else is judged.
    """
    missing = F.array_compact(F.array(*[F.when(_empty(F.col(f), f), F.lit(f"Missing or empty required field: '{f}'")) for f in REQUIRED]))
    errors = F.slice(missing, 1, 1)
    day = lenient_date(F.col("pbac_meeting_date"))
    given = F.coalesce(F.col("pbac_meeting_date"), F.lit("")) != ""
    bad_date = F.when(given & day.isNull(), F.concat(F.lit("Could not parse date: '"), "pbac_meeting_date", F.lit("'. Setting to null.")))
    heads = F.transform("sections", lambda s, i: F.when(F.coalesce(s["heading"], F.lit("")) == "", F.concat(F.lit("Section at index "), i.cast("string"), F.lit(" is missing a 'heading'."))))
    warnings = F.when(F.size(errors) > 0, F.array().cast("array<string>")).otherwise(F.array_compact(F.concat(F.array(bad_date), heads)))
    out = docs.withColumn("errors", errors).withColumn("warnings", warnings)
    iso = F.when(F.size("errors") > 0, F.col("pbac_meeting_date")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    status = F.when(F.size("errors") > 0, "error").when(F.size("warnings") > 0, "success_with_warnings").otherwise("success")
    return out.withColumn("pbac_meeting_date", iso).withColumn("status", status)


def _empty(c: Column, name: str) -> Column:
    return c.isNull() | ((F.size(c) == 0) if name == "sections" else (c == ""))


def checked_payload(raw: Column) -> Column:
    """struct(payload, problems) of a model's answer in JSON: the parsed payload, and an array of reasons, empty if it is valid. Unknown top-level keys are wrong. The answer is parsed once by its schema."""
    known = F.array(*map(F.lit, ("semantic_purpose", "persona_relevance_scores", "typed_entities", "quality_assessment")))
    unit = lambda c: c.isNotNull() & (c >= 0) & (c <= 1)
    text = lambda c: F.coalesce(F.length(c) > 0, F.lit(False))

    def problems(x: Column) -> Column:
        parsed = x["parsed"]
        sp, qa, pr, te = (x["payload"][k] for k in ("semantic_purpose", "quality_assessment", "persona_relevance_scores", "typed_entities"))
        rules = [
            (~parsed, "not JSON"),
            (parsed & (F.size(F.array_except(x["keys"], known)) > 0), "unknown key"),
            (parsed & ~F.coalesce(sp["value"].isin(*PURPOSES), F.lit(False)), "semantic_purpose.value"),
            (parsed & ~(unit(sp["confidence"]) & text(sp["justification"])), "semantic_purpose"),
            (parsed & ~F.coalesce(F.forall(F.array(*map(F.lit, PERSONAS)), lambda k: unit(F.try_element_at(pr, k)["score"]) & text(F.try_element_at(pr, k)["justification"])), F.lit(False)), "persona_relevance_scores"),
            (parsed & ~F.coalesce(F.forall(te, lambda e: e["name"].isNotNull() & F.coalesce(e["type"].isin(*ENTITY_TYPES), F.lit(False))), F.lit(False)), "typed_entities"),
            (parsed & ~(unit(qa["confidence"]) & qa["is_ambiguous"].isNotNull() & text(qa["justification"])), "quality_assessment"),
        ]
        return F.struct(x["payload"].alias("payload"), F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(why)) for c, why in rules])).alias("problems"))

    read = F.struct(F.from_json(raw, PAYLOAD).alias("payload"), F.try_parse_json(raw).isNotNull().alias("parsed"), F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")).alias("keys"))
    # bound as the only element of an array: named in the rules it would be parsed anew for each
    return F.transform(F.array(read), problems)[0]


def payload_errors(raw: Column) -> Column:
    """What is wrong with a model's answer in JSON: an array of reasons, empty if it is valid."""
    return checked_payload(raw)["problems"]
