"""Enrichment through pluggable models: cheap rows first, errors as data, failed rows in quarantine."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import fenced
from ..functions.text import chunk_type_snake
from .calls import Calls, Factory, call_model
from .predicates import low_value
from .quality import ENTITY_TYPES, PAYLOAD, PERSONAS, PURPOSES, checked_payload

#: Prompts by name; {name} marks are filled in.
PROMPTS = {"chunk_enrichment": "DOCUMENT: {title}\nSECTION: {section}\nTEXT: {text}", "table_summary": "Summarise this table:\n{table}", "global_metadata": "Extract metadata:\n{text}",
    "aspect_summaries": "Summarise the clinical and the economic aspects as JSON with clinical_summary and economic_summary:\n{text}", "page_extraction": "Text of page {page}:\n{text}", "document_extraction": "Extract the fields of this document as JSON:\n{text}", "json_repair": "Return this as valid JSON and nothing else:\n{text}"}


UNKNOWN_TITLE = "Unknown Document"


def _struct(ddl: str) -> str:
    return "struct<" + ",".join(f.replace(" ", ":", 1) for f in ddl.split(", ")) + ">"


def load_prompts(folder: str) -> dict[str, str]:
    """Prompts of a folder of the driver by name: <name>.txt each."""
    return {p.stem: p.read_text(encoding="utf-8") for p in sorted(Path(folder).glob("*.txt"))}


def render(name: str, registry: dict[str, str] | None = None, /, **values: Column) -> Column:
    """A prompt of the registry with its {marks} replaced, null as nothing; an unknown name is an error."""
    prompts = PROMPTS if registry is None else registry
    if name not in prompts:
        raise KeyError(f"no prompt named {name}; known: {', '.join(sorted(prompts))}")
    c = F.lit(prompts[name])
    for k, v in values.items():
        c = F.replace(c, F.lit("{" + k + "}"), F.coalesce(v, F.lit("")))
    return c


def offline_model() -> Callable[[str], str]:
    """A model for tests and dry runs: a payload with a purpose from the prompt's digest, in a code fence for one prompt in 7; an
    error for one in 23, and a purpose that isn't in the vocabulary for one in 11."""
    def answer(prompt: str) -> str:
        n = hashlib.md5(prompt.encode()).digest()
        if n[0] % 23 == 0:
            raise ValueError("no answer")
        why = {"justification": "offline"}
        payload = {
            "semantic_purpose": {"value": PURPOSES[n[1] % len(PURPOSES)] if n[2] % 11 else "Other", "confidence": n[3] % 5 / 4, **why},
            "persona_relevance_scores": {p: {"score": 0.5, **why} for p in PERSONAS},
            "typed_entities": [{"name": "offline", "type": ENTITY_TYPES[n[4] % len(ENTITY_TYPES)]}],
            "quality_assessment": {"confidence": 1.0, "is_ambiguous": False, **why},
        }
        raw = json.dumps(payload)
        return f"```json\n{raw}\n```" if n[2] % 7 == 0 else raw

    return answer


def specialist(df: DataFrame, prompt: str, factory: Factory, check: Callable[[Column], Column], calls: Calls | None = None) -> DataFrame:
    """Adds payload and error, one of them null: the model's answer, out of its fence, parsed and checked. Rows with a null prompt aren't asked, and have neither.

    check: of a JSON column, a struct of payload and problems (what is wrong with it), made of one parse.
    """
    asked = call_model(df, prompt, factory, "__answer", "__error", calls).withColumn("__json", fenced(F.col("__answer")))
    asked = asked.withColumn("__checked", F.when(F.col("__json").isNotNull(), check(F.col("__json"))))
    wrong = F.concat(F.lit("invalid payload: "), F.array_join("__checked.problems", ", "))
    bad = F.size("__checked.problems") > 0
    return asked.withColumn("payload", F.when(~bad, F.col("__checked.payload"))).withColumn("error", F.when(F.col("__error").isNotNull(), F.col("__error")).when(bad, wrong)).drop("__answer", "__error", "__json", "__checked")


def default_payload() -> Column:
    """What low-value chunks get without a call."""
    low = F.struct(F.lit(0.0).alias("score"), F.lit("Low-value content.").alias("justification"))
    return F.struct(
        F.struct(F.lit("Miscellaneous").alias("value"), F.lit(1.0).alias("confidence"), F.lit("Programmatically flagged as low-value content.").alias("justification")).alias("semantic_purpose"),
        F.create_map(*[x for p in PERSONAS for x in (F.lit(p), low)]).alias("persona_relevance_scores"),
        F.array().cast("array<struct<name:string,type:string>>").alias("typed_entities"),
        F.struct(F.lit(0.0).alias("confidence"), F.lit(True).alias("is_ambiguous"), F.lit("Skipped LLM enrichment due to low textual content.").alias("justification")).alias("quality_assessment"),
    )


def enrich(chunks: DataFrame, factory: Factory = offline_model, calls: Calls | None = None) -> DataFrame:
    """Chunks (chunk_id, text, chunk_type, [doc_title, section_path], ...) with semantic_purpose, persona_relevance_scores, typed_entities,
    quality_assessment, the chunk type that follows, and error.

    The model sees the document's title, the section's path and the text, and answers with a payload in JSON. What breaks its rules
    (checked_payload()) is an error of the row, as a failing call is; such rows keep their type and have no payload. Low-value chunks get the default
    payload and have no prompt, so no call is made for them: chunks are read once, and judged once. Only chunks of the
    type semantic_text take the purpose as their new type.
    """
    title = F.coalesce(F.col("doc_title"), F.lit(UNKNOWN_TITLE)) if "doc_title" in chunks.columns else F.lit(UNKNOWN_TITLE)
    path = F.array_join("section_path", " -> ") if "section_path" in chunks.columns else F.lit("")
    marked = chunks.withColumn("__low", F.coalesce(low_value(F.col("text")), F.lit(True)))
    asked = specialist(marked.withColumn("__prompt", F.when(~F.col("__low"), render("chunk_enrichment", title=title, section=path, text=F.col("text")))), "__prompt", factory, checked_payload, calls)
    asked = asked.withColumn("payload", F.when(F.col("__low"), default_payload().cast(_struct(PAYLOAD))).otherwise(F.col("payload")))
    value = F.col("payload.semantic_purpose.value")
    kind = F.when(F.col("__low"), "miscellaneous").when((F.col("chunk_type") == "semantic_text") & value.isNotNull(), chunk_type_snake(value)).otherwise(F.col("chunk_type"))
    parts = [f.split(" ", 1)[0] for f in PAYLOAD.split(", ")]
    return asked.withColumns({"chunk_type": kind, **{c: F.col(f"payload.{c}") for c in parts}}).select(*chunks.columns, *parts, "error")


def quarantine_split(enriched: DataFrame, store: str, more: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantine of chunk_id, the columns in more, error_message, original_chunk as JSON). Rows are written to `store` first and both halves read them there, so that no model is asked twice."""
    enriched.write.mode("overwrite").parquet(store)
    whole = enriched.sparkSession.read.schema(enriched.schema).parquet(store)
    keep = [c for c in enriched.columns if c not in ("error", "semantic_purpose", "persona_relevance_scores", "typed_entities", "quality_assessment")]
    bad = whole.filter("error is not null")
    return whole.filter("error is null").drop("error"), bad.select("chunk_id", *more, F.col("error").alias("error_message"), F.to_json(F.struct(*keep)).alias("original_chunk"))


def ordered_chunks(chunks: DataFrame) -> DataFrame:
    """By first page, then id; chunks without a page last."""
    return chunks.orderBy(F.get("page_numbers", F.lit(0)).asc_nulls_last(), "chunk_id")


def first_nonnull_merge(pages: DataFrame, fields: list[str]) -> DataFrame:
    """For each document the value of the first page that has one, field by field."""
    full = lambda f: F.when(F.col(f).isNotNull() & (F.col(f) != ""), F.struct("page", F.col(f).alias("v")))
    return pages.groupBy("doc_id").agg(*[F.min(full(f))["v"].alias(f) for f in fields])


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("status").agg(F.count("*").alias("n"))
