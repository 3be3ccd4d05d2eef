"""Test-only adapters: driver tables -> bronze raw events of each type.

These only re-shape the given tables into the event payloads the pipeline expects
(one bronze row per source row, one projection each; the match adapter also nests
an order's line items as the survivors array). They compute nothing the models
compute. Every formula here is mirrored 1:1 in the DuckDB oracle.

Mapping (``e`` = events, ``o`` = orders, ``l`` = lineitem):
  session_event        every e row; action by e.event_type; session = user:date; some rows twice,
                       exactly or with another region and a later load
  store_transaction    e rows with event_type 'purchase', a few with a negative price
  player_registration  e rows with event_type 'signup' (many per user; staging keeps the latest)
  progression_event    e rows with event_type 'view'
  mmr_update           every o row; player = o_custkey
  match_completed      every o row; survivors = its line items (player = l_suppkey); some killer
                       perks joined into one string; one killer with impossible kill counts
  metering / query_log usage logs from l rows; storage from o rows
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.functions import fixed

ACTION_OF_EVENT = {"signup": "login", "error": "logout", "click": "match_start",
                   "view": "store_visit", "purchase": "store_purchase"}
WAREHOUSES = ["ingest_wh", "transform_wh", "analytics_wh"]


def _pick(values: list[str], idx: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[idx]


def _iso(ts: Column) -> Column:
    # explicit microseconds: to_json would truncate a timestamp to milliseconds
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _plus_seconds(ts: Column, n: Column) -> Column:
    return F.timestamp_add("SECOND", n, ts)


def _filename(kind: str, ts: Column) -> Column:
    return F.concat(F.lit(kind + "/"), F.date_format(ts, "yyyy/MM/dd/HH"), F.lit("/batch_00000.json"))


def _bronze(kind: str, payload: Column, ts: Column, load_ts: Column) -> list[Column]:
    # struct -> VARIANT object directly (no JSON text round trip); NULL fields stay as
    # JSON nulls, i.e. present keys, as a JSON producer that writes nulls would emit
    return [F.to_variant_object(payload).alias("raw_data"),
            _filename(kind, ts).alias("filename"),
            load_ts.cast("timestamp_ntz").alias("load_ts")]


class DriverTables:
    """Lazy readers over ``/root/testdata/sf*/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # ---- events-derived ------------------------------------------------------
    def _events(self, event_type: str | None = None) -> DataFrame:
        e = self.table("events")
        return e.where(F.col("event_type") == event_type) if event_type else e

    def raw_session_event(self) -> DataFrame:
        e = self._events()
        uid, ts = F.col("user_id"), F.col("ts")
        action = F.lit(None).cast("string")
        for k, v in ACTION_OF_EVENT.items():
            action = F.when(F.col("event_type") == k, v).otherwise(action)
        payload = F.struct(
            F.lit("session_event").alias("event_type"),
            F.col("event_id").cast("string").alias("event_id"),
            _iso(ts).alias("timestamp"),
            F.concat(F.lit("b"), uid.cast("string")).alias("bhvr_id"),
            uid.cast("string").alias("player_id"),
            F.concat(uid.cast("string"), F.lit(":"), F.to_date(ts).cast("string")).alias("session_id"),
            action.alias("action"),
            _pick(fixed.PLATFORMS, uid % 8).alias("platform"),
            _pick(fixed.REGIONS, uid % 7).alias("region"),
            F.concat(F.lit("7."), (uid % 4).cast("string"), F.lit(".0")).alias("client_version"),
        )
        def bronze(rows: DataFrame, body: Column, later: int) -> DataFrame:
            return rows.select(*_bronze("session_event", body, ts,
                                        _plus_seconds(ts, F.col("event_id") % 3600 + later)))
        # exact duplicates, and near duplicates that another load brings with another region
        near = payload.withField("region", _pick(fixed.REGIONS, (uid + 1) % 7))
        return (bronze(e, payload, 0).unionByName(bronze(e.where("event_id % 17 = 0"), payload, 0))
                .unionByName(bronze(e.where("event_id % 23 = 0"), near, 600)))

    def raw_store_transaction(self) -> DataFrame:
        e = self._events("purchase")
        uid, ts, eid = F.col("user_id"), F.col("ts"), F.col("event_id")
        item_type = _pick(fixed.ITEM_TYPES, eid % 10)
        payload = F.struct(
            F.lit("store_transaction").alias("event_type"),
            eid.cast("string").alias("event_id"),
            _iso(ts).alias("timestamp"),
            F.concat(F.lit("b"), uid.cast("string")).alias("bhvr_id"),
            uid.cast("string").alias("player_id"),
            F.concat(F.lit("txn_"), eid.cast("string")).alias("transaction_id"),
            F.concat(item_type, F.lit("_"), (eid % 5).cast("string")).alias("item_id"),
            item_type.alias("item_type"),
            _pick(fixed.CURRENCIES, eid % 6).alias("currency"),
            F.floor(F.col("value") * 100).cast("int").alias("amount"),
            (F.col("value") * F.when(eid % 101 == 0, -1).otherwise(1)).cast("decimal(10,2)").alias("amount_usd"),
            _pick(fixed.PLATFORMS, uid % 8).alias("platform"),
        )
        return e.select(*_bronze("store_transaction", payload, ts, _plus_seconds(ts, eid % 3600)))

    def raw_player_registration(self) -> DataFrame:
        e = self._events("signup")
        uid, ts, eid = F.col("user_id"), F.col("ts"), F.col("event_id")
        name = F.concat(F.lit("player"), uid.cast("string"), F.lit("_v"), (eid % 3).cast("string"))
        accounts = F.array(
            F.struct(_pick(fixed.PLATFORMS, uid % 8).alias("platform"),
                     uid.cast("string").alias("platform_player_id"),
                     name.alias("display_name"),
                     _iso(ts).alias("linked_at"),
                     F.lit(True).alias("is_primary")),
            F.struct(_pick(fixed.PLATFORMS, (uid + 3) % 8).alias("platform"),
                     F.concat(F.lit("alt"), uid.cast("string")).alias("platform_player_id"),
                     F.concat(F.lit("alt_player"), uid.cast("string")).alias("display_name"),
                     F.lit(None).cast("string").alias("linked_at"),
                     F.lit(False).alias("is_primary")),
        )
        payload = F.struct(
            F.lit("player_registration").alias("event_type"),
            eid.cast("string").alias("event_id"),
            _iso(ts).alias("timestamp"),
            F.concat(F.lit("b"), uid.cast("string")).alias("bhvr_id"),
            name.alias("display_name"),
            _pick(fixed.PLATFORMS, uid % 8).alias("primary_platform"),
            _pick(fixed.REGIONS, uid % 7).alias("region"),
            accounts.alias("platform_accounts"),
        )
        return e.select(*_bronze("player_registration", payload, ts, _plus_seconds(ts, eid % 3600)))

    def raw_progression_event(self) -> DataFrame:
        e = self._events("view")
        uid, ts, eid = F.col("user_id"), F.col("ts"), F.col("event_id")
        before = F.floor(F.col("value")).cast("int")
        payload = F.struct(
            F.lit("progression_event").alias("event_type"),
            eid.cast("string").alias("event_id"),
            _iso(ts).alias("timestamp"),
            uid.cast("string").alias("player_id"),
            _pick(["bloodpoints", "rift", "prestige"], eid % 3).alias("progression_type"),
            F.concat(F.lit("surv_"), (uid % 15).cast("string")).alias("character_id"),
            before.alias("value_before"),
            (before + (eid % 50).cast("int")).alias("value_after"),
        )
        return e.select(*_bronze("progression_event", payload, ts, _plus_seconds(ts, eid % 3600)))

    # ---- orders-derived ------------------------------------------------------
    @staticmethod
    def _order_ts() -> Column:
        return _plus_seconds(F.col("o_orderdate"), F.col("o_orderkey") % 86400)

    def raw_mmr_update(self) -> DataFrame:
        o = self.table("orders")
        ts, price = self._order_ts(), F.floor(F.col("o_totalprice"))
        payload = F.struct(
            F.lit("mmr_update").alias("event_type"),
            F.concat(F.lit("mmr_"), F.col("o_orderkey").cast("string")).alias("event_id"),
            _iso(ts).alias("timestamp"),
            F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("bhvr_id"),
            F.col("o_custkey").cast("string").alias("player_id"),
            F.when(F.col("o_orderstatus") == "F", "killer")
             .when(F.col("o_orderstatus") == "O", "survivor").alias("role"),
            (price % 1900).cast("int").alias("mmr_before"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
             .otherwise(price % 2201).cast("int").alias("mmr_after"),
        )
        return o.select(*_bronze("mmr_update", payload, ts,
                                 _plus_seconds(ts, F.col("o_orderkey") % 7200)))

    def raw_match_completed(self) -> DataFrame:
        o, li = self.table("orders"), self.table("lineitem")
        qty = F.floor(F.col("l_quantity"))
        # the plain columns are shuffled; the survivors' text is made behind the exchange
        lines = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                          "l_returnflag").repartition("l_orderkey")
        surv = lines.select(
            "l_orderkey",
            F.struct(
                F.col("l_linenumber").alias("n"),
                F.struct(
                    F.concat(F.lit("b"), F.col("l_suppkey").cast("string")).alias("player_id"),
                    F.col("l_suppkey").cast("string").alias("platform_player_id"),
                    F.concat(F.lit("surv_"), (F.col("l_partkey") % 15).cast("string")).alias("character_id"),
                    F.array(F.concat(F.lit("sperk_"), (F.col("l_partkey") % 11).cast("string")),
                            F.concat(F.lit("sperk_"), (F.col("l_suppkey") % 13).cast("string")),
                            F.concat(F.lit("sperk_"), F.col("l_linenumber").cast("string")),
                            F.concat(F.lit("sperk_"), (qty % 7).cast("string"))).alias("perks"),
                    (F.col("l_returnflag") == "N").alias("escaped"),
                    (qty % 6).cast("int").alias("generators_completed"),
                    (F.floor(F.col("l_extendedprice")) % 30000).cast("int").alias("score"),
                ).alias("s")).alias("e"))
        # nest each order's line items (bounded: one order's lines) in line order
        nested = (surv.groupBy("l_orderkey")
                  .agg(F.sort_array(F.collect_list("e")).alias("arr"))
                  .select(F.col("l_orderkey").alias("o_orderkey"),
                          F.col("arr.s").alias("survivors")))
        ts, price, key = self._order_ts(), F.floor(F.col("o_totalprice")), F.col("o_orderkey")
        killer = F.struct(
            F.concat(F.lit("b"), F.col("o_custkey").cast("string")).alias("player_id"),
            F.col("o_custkey").cast("string").alias("platform_player_id"),
            _pick(fixed.PLATFORMS, F.col("o_custkey") % 8).alias("platform"),
            F.concat(F.lit("killer_"), (F.col("o_custkey") % 12).cast("string")).alias("character_id"),
            F.array(F.concat(F.lit("kperk_"), (F.col("o_custkey") % 7).cast("string")),
                    F.concat(F.lit("kperk_"), (key % 11).cast("string")),
                    F.concat(F.lit("kperk_"), (key % 13).cast("string")),
                    F.concat(F.lit("kperk_"), (price % 17).cast("string"))).alias("perks"),
            (price % 5 + F.when(F.col("o_custkey") % 12 == 11, 5).otherwise(0)).cast("int").alias("kills"),
            (price % 13).cast("int").alias("hooks"),
            (price % 10000).cast("int").alias("score"),
        )
        payload = F.struct(
            F.lit("match_completed").alias("event_type"),
            F.concat(F.lit("match_evt_"), key.cast("string")).alias("event_id"),
            F.concat(F.lit("match_"), key.cast("string")).alias("match_id"),
            _iso(ts).alias("timestamp"),
            (F.lit(180) + price % 721).cast("int").alias("duration_seconds"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None))
             .otherwise(F.concat(F.lit("map_"), F.substring("o_orderpriority", 1, 1))).alias("map_id"),
            _pick(fixed.GAME_MODES, key % 6).alias("game_mode"),
            killer.alias("killer"),
            F.col("survivors"),
        )
        raw, filename, load_ts = _bronze("match_completed", payload, ts, _plus_seconds(ts, key % 7200))
        joined = payload.withField("killer", killer.withField("perks", F.array_join(killer["perks"], ",")))
        raw = F.when(key % 19 == 0, F.to_variant_object(joined)).otherwise(F.to_variant_object(payload))
        return o.join(nested, "o_orderkey", "left").select(raw.alias("raw_data"), filename, load_ts)

    # ---- usage logs ------------------------------------------------------------
    def metering(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(
            _pick(WAREHOUSES, F.col("l_suppkey") % 3).alias("warehouse_name"),
            F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate")).alias("start_time"),
            (F.col("l_quantity") / 10 + F.col("l_tax")).alias("credits_used"),
            (F.col("l_quantity") / 10).alias("credits_used_compute"),
            F.col("l_tax").alias("credits_used_cloud_services"),
        )

    def query_log(self) -> DataFrame:
        li = self.table("lineitem")
        price = F.floor(F.col("l_extendedprice"))
        return li.select(
            F.concat(F.lit("q"), F.col("l_orderkey").cast("string"), F.lit("_"),
                     F.col("l_linenumber").cast("string")).alias("query_id"),
            F.when(F.col("l_linestatus") == "F", "SELECT").otherwise("INSERT").alias("query_type"),
            F.when(F.col("l_returnflag") == "A", F.lit(None))
             .otherwise(_pick(WAREHOUSES, F.col("l_suppkey") % 3)).alias("warehouse_name"),
            F.concat(F.lit("user_"), (F.col("l_partkey") % 20).cast("string")).alias("user_name"),
            F.when(F.col("l_suppkey") % 2 == 0, "ANALYST").otherwise("TRANSFORMER").alias("role_name"),
            F.lit("ANALYTICS").alias("database_name"),
            _pick(["STAGING", "INTERMEDIATE", "MARTS"], F.col("l_linenumber") % 3).alias("schema_name"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "FAIL")
             .otherwise("SUCCESS").alias("execution_status"),
            F.timestamp_add("HOUR", F.col("l_linenumber"), F.col("l_shipdate")).alias("start_time"),
            price.alias("total_elapsed_time"),
            F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("execution_time"),
            (price * 1048576 * F.col("l_linenumber")).alias("bytes_scanned"),
            (F.floor(F.col("l_quantity")) * 100).alias("rows_produced"),
            F.col("l_linenumber").cast("bigint").alias("partitions_scanned"),
            F.floor(F.col("l_quantity")).alias("partitions_total"),
            F.concat(F.lit("SELECT * FROM part WHERE p_partkey = "), F.col("l_partkey").cast("string"),
                     F.lit(" -- "), F.repeat(F.lit("x"), F.col("l_linenumber") * 40)).alias("query_text"),
            F.col("l_tax").alias("credits_used_cloud_services"),
        )

    def storage(self) -> DataFrame:
        o = self.table("orders")
        price = F.floor(F.col("o_totalprice"))
        return o.select(
            F.to_date("o_orderdate").alias("usage_date"),
            (price * 1048576).alias("storage_bytes"),
            (F.col("o_custkey") * 1024).alias("stage_bytes"),
            (price * 1024).alias("failsafe_bytes"),
        )
