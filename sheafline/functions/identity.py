"""Digests, canonical JSON and the keys under which work is reused.

A struct or an array is written by Spark itself with its fields in alphabetical order. JSON that only
the data knows goes through the variant type, whose objects hold their keys sorted.
"""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheafline.plans import schema as S

#: Options that never change what is computed.
VOLATILE_OPTIONS = ("api_key", "stream")
#: Options that steer the call and are not sent to the provider.
CONTROL_OPTIONS = ("api_key", "stream", "base_url", "timeout", "max_attempts", "context_window", "max_prompt_tokens")


def digest(content: Column) -> Column:
    """SHA-256 in hex of bytes or of a text's UTF-8; null for null."""
    return F.sha2(content, 256)


def canonical_text(value: object) -> str:
    """A driver-side value as JSON with sorted keys and no white space, characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def canonical_ascii(value: object) -> str:
    """The same with every other character escaped, as the workflow's own keys are formed."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"))


def canonical_json(text: Column) -> Column:
    """JSON text with sorted keys and no white space; null where it isn't JSON."""
    return F.to_json(F.try_parse_json(text))


def canonical_struct(**fields: Column) -> Column:
    """Columns as one JSON object, keys sorted, nulls kept."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def escape_ascii(text: Column) -> Column:
    """JSON text with each character beyond ASCII as \\uXXXX, surrogate pairs beyond the BMP."""

    def one(c: Column) -> Column:
        units = F.lower(F.hex(F.encode(c, "UTF-16BE")))
        return F.when(F.octet_length(c) == 1, c).otherwise(F.regexp_replace(units, "(.{4})", r"\\u$1"))

    plain = F.regexp_like(text, F.lit(r"^\p{ASCII}*$"))
    return F.when(plain, text).otherwise(F.array_join(F.transform(F.split(text, ""), one), ""))


def without(options: Column, names: tuple[str, ...]) -> Column:
    """map<string, V> less the named keys."""
    return F.map_filter(options, lambda k, _: ~k.isin(*names))


def by_key(options: Column) -> Column:
    """A map with its entries in the order of its keys; values need no order."""
    keys = F.array_sort(F.map_keys(options))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(options, k)))


def sorted_map(options: Column) -> Column:
    """A map's JSON with sorted keys."""
    return F.to_json(by_key(options), {"ignoreNullFields": "false"})


def request_key(
    provider: Column, model: Column, version: Column, prompt: Column, document_hash: Column, image_hashes: Column,
    schema_hash: Column, options: Column,
) -> Column:
    """SHA-256 over all that decides a model's answer. options: map; volatile ones don't count."""
    hashes = F.struct(document_hash.alias("document"), image_hashes.alias("images"))
    body = canonical_struct(
        input_hashes=hashes,
        model=model,
        model_version=version,
        normalized_options=by_key(without(options, VOLATILE_OPTIONS)),
        provider=provider,
        rendered_prompt=prompt,
        schema_hash=schema_hash,
    )
    return digest(body)


def processing_key(processor: Column, version: Column, input_hashes: Column, options: Column) -> Column:
    """SHA-256 over a stage's identity: options is canonical JSON text, input_hashes an array."""
    head = F.to_json(input_hashes)
    name = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    body = F.concat(
        F.lit('{"input_hashes":'), head, F.lit(',"normalized_options":'), options, F.lit(',"processor":'), name(processor),
        F.lit(',"processor_version":'), name(version), F.lit("}"),
    )
    return digest(escape_ascii(body))


def inputs_hash(inputs: Column) -> Column:
    """SHA-256 over all that a stage consumes, in order: an array of texts and of files' digests."""
    return digest(escape_ascii(F.to_json(inputs)))


def options_hash(options: Column) -> Column:
    """SHA-256 of options, canonical JSON text."""
    return digest(escape_ascii(options))


def stage_key(stage: str, inputs: Column, options: Column) -> Column:
    """The processing key of a stage, made of its processor, what it consumes and its options."""
    name, version = S.PROCESSORS[stage]
    return processing_key(F.lit(name), F.lit(version), F.array(inputs_hash(inputs)), options)


def document_key(input_hash: Column, options: Column) -> Column:
    """The processing key of a whole document; no run takes part in it."""
    name, version = S.WORKFLOW
    return processing_key(F.lit(name), F.lit(version), F.array(input_hash), options)


def piped_key(processor: Column, version: Column, file_digest: Column, options: Column) -> Column:
    """The processors' own formula: four parts between bars."""
    return digest(F.concat_ws("|", processor, version, file_digest, options))


def stage_id(stage: Column, page: Column) -> Column:
    return F.concat(stage, F.lit(":"), F.coalesce(page.cast("string"), F.lit("document")))


def run_id() -> Column:
    """Random: it names a run and never takes part in a key."""
    return F.concat(F.lit("run-"), F.uuid())


def attempt_id(node: Column, attempt: Column) -> Column:
    return F.format_string("%s-attempt-%03d", F.coalesce(node, F.lit("call")), attempt.cast("int"))
