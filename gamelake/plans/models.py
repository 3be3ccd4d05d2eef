"""Wires the named models together from six bronze sources (the SURVEY section 0 graph).

``Models`` is lazy: each attribute is a DataFrame built on first use and shared by
every mart that reads it. ``materialize=True`` writes every model as a parquet table
under the shared checkpoint folder and reads it back, so marts start from stored tables
instead of re-running the lineage, and the marts themselves are stored.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from gamelake.plans import intermediate as I
from gamelake.plans import match as M
from gamelake.plans import player as P
from gamelake.plans import revenue as R
from gamelake.plans import staging as S
from gamelake.session import scratch_path
from gamelake.operators.joins import unique_dim
from gamelake.sources.seeds import SEED_KEYS, seed

RAW_KINDS = ["match_completed", "session_event", "store_transaction", "mmr_update",
             "player_registration", "progression_event"]


def share(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` behind an exchange by ``columns``, so that two readers in one plan share its rows.

    Readers of different columns would differ in their plans below the exchange; naming the columns
    in it keeps them there for both, and Spark runs equal exchanges once.
    """
    return df.repartition(*columns)


class Models:
    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], as_of=None,
                 materialize: bool = False, seeds: dict[str, DataFrame] | None = None, complete: bool = False):
        """``as_of``: the date recency counts from (a date, "latest" in the data, or None: today).

        ``seeds`` replaces built-in lookups by name (``read_seed`` reads them from CSV)."""
        self.spark, self.raw, self.as_of, self.materialize = spark, raw, as_of, materialize
        self.complete = complete  # whole survivor payloads beside the typed fields
        self.seeds = {n: unique_dim(d, SEED_KEYS[n]) for n, d in (seeds or {}).items()}
        self._run = uuid.uuid4().hex[:8]

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, **kw) -> "Models":
        from gamelake.sources.adapters import DriverTables
        """Models over the driver tables, whose data has ended: recency as of their latest date."""
        kw.setdefault("as_of", "latest")
        t = DriverTables(spark, sf_dir)
        raw = {k: getattr(t, f"raw_{k}")() for k in RAW_KINDS}
        m = cls(spark, raw, **kw)
        m.driver = t
        return m

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        if not self.materialize:
            return df
        from gamelake.operators.incremental import materialize
        return materialize(self.spark, df, name, "table", scratch_path(self.spark, "tables", self._run, name))

    def seed(self, name: str) -> DataFrame:
        return self.seeds[name] if name in self.seeds else seed(self.spark, name)

    # staging
    @cached_property
    def stg_matches(self): return self._keep("stg_matches", S.stg_matches(self.raw["match_completed"], self.complete))
    @cached_property
    def stg_sessions(self): return self._keep("stg_sessions", S.stg_sessions(self.raw["session_event"]))
    @cached_property
    def stg_store_transactions(self):
        return self._keep("stg_store_transactions", S.stg_store_transactions(self.raw["store_transaction"]))
    @cached_property
    def stg_mmr_updates(self): return self._keep("stg_mmr_updates", S.stg_mmr_updates(self.raw["mmr_update"]))
    @cached_property
    def stg_players(self): return self._keep("stg_players", S.stg_players(self.raw["player_registration"]))
    @cached_property
    def stg_progression(self): return self._keep("stg_progression", S.stg_progression(self.raw["progression_event"]))

    # intermediate
    @cached_property
    def int_match_enriched(self):
        return self._keep("int_match_enriched", I.int_match_enriched(
            self.stg_matches, self.seed("seed_killers"), self.seed("seed_survivors")))
    def matches_with(self, *fields: str) -> DataFrame:
        """``stg_matches`` with these survivor fields: a reader of a few does not cast the others
        out of every payload. A stored model is read as it is."""
        if self.materialize:
            return self.stg_matches
        return S.stg_matches(self.raw["match_completed"], self.complete, fields)
    def matches_shared(self, columns: list[str], *fields: str) -> DataFrame:
        """``matches_with`` these survivor fields for two readers in one plan, that use ``columns`` of
        the match. Their payloads are deduplicated and read once."""
        m = self.matches_with(*fields)
        return m if self.materialize else share(m, [*columns, "survivors"])
    def match_survivors(self, *fields: str) -> DataFrame:
        """``int_match_enriched`` with these survivor fields alone: each is a cast per survivor. Over
        stored matches the rows are made from those: fewer bytes than the stored, flattened model."""
        return self.survivors_of(self.matches_with(*fields))
    def survivors_of(self, matches: DataFrame) -> DataFrame:
        return I.int_match_enriched(matches, self.seed("seed_killers"), self.seed("seed_survivors"))
    @cached_property
    def int_player_daily_activity(self):
        return self._keep("int_player_daily_activity", I.int_player_daily_activity(self.stg_sessions))
    @cached_property
    def int_session_metrics(self):
        return self._keep("int_session_metrics", I.int_session_metrics(self.stg_sessions))
    @cached_property
    def int_revenue_daily(self):
        return self._keep("int_revenue_daily", I.int_revenue_daily(self.stg_store_transactions))
    @cached_property
    def int_player_first_last(self):
        return self._keep("int_player_first_last",
                          I.int_player_first_last(self.stg_sessions, self.stg_players, self.as_of))

    # marts
    @cached_property
    def fct_dau_mau(self): return self._keep("fct_dau_mau", P.fct_dau_mau(self.int_player_daily_activity))
    @cached_property
    def fct_player_retention(self):
        return self._keep("fct_player_retention",
                          P.fct_player_retention(self.int_player_first_last, self.int_player_daily_activity))
    @cached_property
    def fct_player_lifetime(self):
        return self._keep("fct_player_lifetime", P.fct_player_lifetime(
            self.int_player_first_last, self.stg_store_transactions, self.int_session_metrics,
            self.match_survivors("platform_player_id")))
    @cached_property
    def dim_players(self):
        return self._keep("dim_players", P.dim_players(self.stg_players, self.fct_player_lifetime, self.stg_mmr_updates))
    @cached_property
    def fct_match_outcomes(self):
        return self._keep("fct_match_outcomes", M.fct_match_outcomes(self.stg_matches, self.seed("seed_killers")))
    @cached_property
    def fct_perk_performance(self):
        m = self.matches_shared(["killer_character_id", "killer_kills", "killer_perks"], "escaped", "perks")
        return self._keep("fct_perk_performance",
                          M.fct_perk_performance(m, self.survivors_of(m), self.seed("seed_perks")))
    @cached_property
    def fct_map_balance(self):
        return self._keep("fct_map_balance", M.fct_map_balance(self.stg_matches, self.seed("seed_maps")))
    @cached_property
    def fct_mmr_distribution(self):
        return self._keep("fct_mmr_distribution", M.fct_mmr_distribution(self.stg_mmr_updates))
    @cached_property
    def fct_daily_revenue(self): return self._keep("fct_daily_revenue", R.fct_daily_revenue(self.int_revenue_daily))
    @cached_property
    def fct_arpdau(self): return self._keep("fct_arpdau", R.fct_arpdau(self.fct_dau_mau, self.fct_daily_revenue))
    @cached_property
    def fct_store_conversion(self):
        return self._keep("fct_store_conversion",
                          R.fct_store_conversion(self.int_player_daily_activity, self.stg_store_transactions))
