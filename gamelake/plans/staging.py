"""Staging models (M-1..M-6): typed projection of bronze VARIANT payloads,
NULL-key filter, and last-load-wins deduplication.

Each function takes a bronze frame (raw_data VARIANT, filename, load_ts). When an
existing target and its high-water mark are given, ``lookback`` first bounds the
scan to recently loaded rows (FLT-6); ``merge_upsert`` then applies the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.functions.semantics import path_string_array, to_array, to_string_array
from gamelake.operators.dedup import latest_by_tied, with_key



def _raw() -> Column:
    return F.col("raw_data")


def vget(path: str, typ: str, v: Column | None = None) -> Column:
    """Lenient path extract + cast: a value of the wrong shape gives NULL, not an error."""
    return F.try_variant_get(_raw() if v is None else v, path, typ)


def ts(path: str = "$.timestamp", v: Column | None = None) -> Column:
    """ISO-8601 string (with or without a trailing Z) to TIMESTAMP_NTZ, zone dropped (S-9)."""
    return vget(path, "timestamp_ntz", v)


def _int(path: str, v: Column | None = None) -> Column:
    """``::int`` rounds half away from zero in the warehouse (S-4): read as double, round.

    The warehouse type holds 38 digits; here a value beyond 64 bits becomes NULL.
    """
    return F.round(vget(path, "double", v)).try_cast("bigint")


def _dedup(raw: DataFrame, key_path: str = "$.event_id") -> DataFrame:
    """Last load wins per key, applied to the bronze rows before the typed projection.

    The key is read from the payload; rows without it are dropped (the staging NULL-key
    filter). Deduplicating first shuffles the compact VARIANT binary instead of the
    wide typed rows (nested arrays of structs), and only winners are parsed. Rows of one
    file and load time are told apart by a hash of the payload, made only for those, so that
    the winner does not depend on the order of the input.
    """
    keyed = with_key(raw, vget(key_path, "string"))
    return latest_by_tied(keyed, "_key", [F.col("load_ts").desc_nulls_first(), F.col("filename").desc_nulls_first()],
                          F.xxhash64(F.to_json("raw_data"))).drop("_key")


CANONICAL_ID = "$.bhvr_id"
SURVIVOR_FIELDS = {"player_id": "string", "platform_player_id": "string", "character_id": "string", "escaped": "boolean",
                   "generators_completed": "double", "score": "double", "perks": "array<string>"}


def _survivors(fields: tuple[str, ...] | None = None) -> Column:
    """Survivors as a typed array; numeric fields stay double here and get the
    warehouse ``::int`` rounding after the flatten (int_match_enriched), where the
    reference applies it.

    Fast path: one typed cast of the whole array, no per-element work. Where it fails
    (a single object instead of an array, a comma-joined perks string, a badly typed
    field) the lenient element-wise path coerces shapes (PRJ-4) and each field.

    ``fields``: the ones to read, for a caller that needs no others (each is a cast per survivor).
    """
    kept = {n: t for n, t in SURVIVOR_FIELDS.items() if fields is None or n in fields}
    whole = "array<struct<" + ", ".join(f"{n} {t}" for n, t in kept.items()) + ">>"
    fast = F.try_variant_get(_raw(), "$.survivors", whole)  # direct path: pushed into the scan
    slow = F.transform(to_array(F.variant_get(_raw(), "$.survivors", "variant")), lambda s: F.struct(*[
        (to_string_array(F.variant_get(s, f"$.{n}", "variant")) if n == "perks" else vget(f"$.{n}", t, s)).alias(n)
        for n, t in kept.items()]))
    return F.coalesce(fast, slow)


def stg_matches(raw: DataFrame, complete: bool = False, survivor_fields: tuple[str, ...] | None = None) -> DataFrame:
    """Match events. ``complete`` adds ``survivor_payloads``: the whole survivors as
    ``array<variant>``, element for element beside the typed ``survivors``, so that fields unknown
    here live on (about the array's size again in storage). ``survivor_fields``: read these alone.
    """
    raw = _dedup(raw)
    parsed = raw.select(
        vget("$.event_id", "string").alias("event_id"),
        vget("$.match_id", "string").alias("match_id"),
        ts().alias("event_timestamp"),
        _int("$.duration_seconds").alias("duration_seconds"),
        vget("$.map_id", "string").alias("map_id"),
        vget("$.game_mode", "string").alias("game_mode"),
        vget("$.killer.player_id", "string").alias("killer_player_id"),
        vget("$.killer.character_id", "string").alias("killer_character_id"),
        path_string_array(_raw(), "$.killer.perks").alias("killer_perks"),
        _int("$.killer.kills").alias("killer_kills"),
        _int("$.killer.hooks").alias("killer_hooks"),
        _int("$.killer.score").alias("killer_score"),
        _survivors(survivor_fields).alias("survivors"),
        *([to_array(F.variant_get(_raw(), "$.survivors", "variant")).alias("survivor_payloads")] if complete else []),
        "filename", "load_ts",
    )
    return parsed


def stg_sessions(raw: DataFrame, dedup: bool = True) -> DataFrame:
    """Session events; ``dedup=False`` leaves deduplication to the caller (a stream)."""
    raw = _dedup(raw) if dedup else raw
    parsed = raw.select(
        vget("$.event_id", "string").alias("event_id"),
        ts().alias("event_timestamp"),
        vget("$.player_id", "string").alias("player_id"),
        vget("$.session_id", "string").alias("session_id"),
        vget("$.action", "string").alias("action"),
        vget("$.platform", "string").alias("platform"),
        vget("$.region", "string").alias("region"),
        vget("$.client_version", "string").alias("client_version"),
        "filename", "load_ts",
    )
    return parsed


def stg_store_transactions(raw: DataFrame) -> DataFrame:
    raw = _dedup(raw)
    parsed = raw.select(
        vget("$.event_id", "string").alias("event_id"),
        ts().alias("event_timestamp"),
        vget("$.player_id", "string").alias("player_id"),
        vget("$.transaction_id", "string").alias("transaction_id"),
        vget("$.item_id", "string").alias("item_id"),
        vget("$.item_type", "string").alias("item_type"),
        vget("$.currency", "string").alias("currency"),
        _int("$.amount").alias("amount"),
        vget("$.amount_usd", "decimal(10,2)").alias("amount_usd"),
        "filename", "load_ts",
    )
    return parsed


def stg_mmr_updates(raw: DataFrame) -> DataFrame:
    """``match_id`` is read but never emitted by producers, so it is NULL in practice."""
    raw = _dedup(raw)
    parsed = raw.select(
        vget("$.event_id", "string").alias("event_id"),
        ts().alias("event_timestamp"),
        vget("$.player_id", "string").alias("player_id"),
        vget("$.match_id", "string").alias("match_id"),
        _int("$.mmr_before").alias("mmr_before"),
        _int("$.mmr_after").alias("mmr_after"),
        (_int("$.mmr_after") - _int("$.mmr_before")).alias("mmr_change"),
        vget("$.role", "string").alias("role"),
        "filename", "load_ts",
    )
    return parsed


def stg_players(raw: DataFrame, canonical_id: str = CANONICAL_ID) -> DataFrame:
    """Latest registration per platform player id (the first linked account's id).

    ``canonical_id``: the payload's path to the id that all accounts of a person share.
    """
    raw = _dedup(raw, "$.platform_accounts[0].platform_player_id")
    parsed = raw.select(
        vget("$.platform_accounts[0].platform_player_id", "string").alias("player_id"),
        vget(canonical_id, "string").alias("bhvr_id"),
        ts().alias("registered_at"),
        vget("$.display_name", "string").alias("username"),
        vget("$.primary_platform", "string").alias("platform"),
        vget("$.region", "string").alias("region"),
        "filename", "load_ts",
    )
    return parsed


def stg_progression(raw: DataFrame) -> DataFrame:
    raw = _dedup(raw)
    parsed = raw.select(
        vget("$.event_id", "string").alias("event_id"),
        ts().alias("event_timestamp"),
        vget("$.player_id", "string").alias("player_id"),
        vget("$.progression_type", "string").alias("progression_type"),
        vget("$.character_id", "string").alias("character_id"),
        _int("$.value_before").alias("value_before"),
        _int("$.value_after").alias("value_after"),
        (_int("$.value_after") - _int("$.value_before")).alias("value_change"),
        "filename", "load_ts",
    )
    return parsed


def extract(df: DataFrame, spec: dict[str, tuple[str, str]], keep: list[str] | None = None) -> DataFrame:
    """Typed projection of VARIANT paths (PRJ-1..PRJ-3): ``{name: (path, type)}``.

    Paths may be dotted (``$.killer.kills``) or indexed (``$.platform_accounts[0].id``).
    """
    return df.select(*(keep or []), *[vget(p, t).alias(n) for n, (p, t) in spec.items()])
