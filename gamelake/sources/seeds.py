"""Reference (seed) dimensions.

The lookups are small, fixed-size tables. They are shipped inside the plan as local
relations (no file that executors would have to find on their own disk) and joined
like any other dimension; the planner sees their size and broadcasts them.
``read_seed`` reads a user-supplied CSV from shared storage with a declared schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SEED_SCHEMAS = {
    "seed_killers": "character_id string, killer_name string, power string, chapter string, release_year int",
    "seed_survivors": "character_id string, survivor_name string, chapter string, release_year int",
    "seed_perks": "perk_id string, perk_name string, perk_type string, role string, tier int, character_origin string",
    "seed_maps": "map_id string, map_name string, realm string, map_size string",
    "seed_store_items": ("item_id string, item_name string, item_type string, character_id string, "
                         "rarity string, price_auric_cells int, price_usd decimal(10,2)"),
}

SEED_KEYS = {"seed_killers": "character_id", "seed_survivors": "character_id", "seed_perks": "perk_id",
             "seed_maps": "map_id", "seed_store_items": "item_id"}

# Our own lookup rows. Ids follow the adapters' id scheme; some generated ids are
# deliberately absent so that left joins keep unmatched rows.
SEED_ROWS = {
    "seed_killers": [
        ("killer_0", "The Warden", "Lockdown", "Chapter 1", 2016),
        ("killer_1", "The Howler", "Echo Scream", "Chapter 1", 2016),
        ("killer_2", "The Tinker", "Clockwork Traps", "Chapter 2", 2017),
        ("killer_3", "The Drifter", "Fog Step", "Chapter 3", 2017),
        ("killer_4", "The Mason", "Stone Wall", "Chapter 4", 2018),
        ("killer_5", "The Weaver", "Silk Snare", "Chapter 5", 2018),
        ("killer_6", "The Ferryman", "Tide Pull", "Chapter 6", 2019),
        ("killer_7", "The Lantern", "Blinding Flare", "Chapter 7", 2020),
        ("killer_8", "The Harvester", "Scythe Throw", "Chapter 8", 2021),
        ("killer_9", "The Archivist", "Memory Loop", "Chapter 9", 2022),
    ],
    "seed_survivors": [
        ("surv_0", "Ada Quill", "Chapter 1", 2016),
        ("surv_1", "Bram Holt", "Chapter 1", 2016),
        ("surv_2", "Cleo Marsh", "Chapter 2", 2017),
        ("surv_3", "Dorian Vale", "Chapter 3", 2017),
        ("surv_4", "Esme Rook", "Chapter 4", 2018),
        ("surv_5", "Finn Arbor", "Chapter 5", 2018),
        ("surv_6", "Greta Lune", "Chapter 6", 2019),
        ("surv_7", "Hugo Pike", "Chapter 7", 2020),
        ("surv_8", "Iris Fenn", "Chapter 8", 2021),
        ("surv_9", "Jonah Crest", "Chapter 9", 2022),
        ("surv_10", "Kaia Storm", "Chapter 10", 2023),
        ("surv_11", "Leon Dusk", "Chapter 11", 2024),
    ],
    "seed_perks": [
        ("kperk_0", "Iron Grip", "tracking", "killer", 3, "killer_0"),
        ("kperk_1", "Cold Trail", "tracking", "killer", 2, "killer_1"),
        ("kperk_2", "Slow Gears", "slowdown", "killer", 3, "killer_2"),
        ("kperk_3", "Heavy Step", "chase", "killer", 1, "killer_3"),
        ("kperk_4", "Last Call", "endgame", "killer", 2, "killer_4"),
        ("kperk_5", "Night Watch", "info", "killer", 3, None),
        ("kperk_6", "Hex Ember", "hex", "killer", 1, None),
        ("kperk_7", "Bone Chill", "slowdown", "killer", 3, "killer_7"),
        ("kperk_8", "Deep Wound", "chase", "killer", 2, None),
        ("sperk_0", "Quick Feet", "exhaustion", "survivor", 3, "surv_0"),
        ("sperk_1", "Second Wind", "healing", "survivor", 2, "surv_1"),
        ("sperk_2", "Steady Hands", "repair", "survivor", 3, "surv_2"),
        ("sperk_3", "Keen Eye", "info", "survivor", 1, "surv_3"),
        ("sperk_4", "Lucky Break", "exhaustion", "survivor", 3, None),
        ("sperk_5", "Team Spirit", "altruism", "survivor", 2, None),
        ("sperk_6", "Shadow Step", "stealth", "survivor", 3, "surv_6"),
        ("sperk_7", "Tough Skin", "endurance", "survivor", 2, None),
        ("sperk_8", "Calm Mind", "stealth", "survivor", 1, "surv_8"),
        ("sperk_9", "Open Door", "endgame", "survivor", 3, None),
        ("sperk_10", "Kindred Bond", "info", "survivor", 2, "surv_10"),
    ],
    "seed_maps": [
        ("map_1", "Rust Yard", "Scrap Fields", "large"),
        ("map_2", "Hollow Chapel", "Old Parish", "medium"),
        ("map_3", "Frost Mill", "North Reach", "small"),
    ],
    "seed_store_items": [
        ("cosmetic_head_0", "Ash Mask", "cosmetic_head", "killer_0", "rare", 720, None),
        ("cosmetic_body_1", "Field Coat", "cosmetic_body", "surv_1", "common", 480, None),
        ("dlc_chapter_2", "Chapter 2 Pack", "dlc_chapter", None, "dlc", None, 6.99),
        ("rift_pass_0", "Rift Pass", "rift_pass", None, "pass", 1000, None),
        ("auric_cells_pack_3", "Cell Bundle", "auric_cells_pack", None, "currency", None, 9.99),
        ("charm_4", "Lucky Charm", "charm", None, "common", 180, None),
    ],
}


def seed(spark: SparkSession, name: str) -> DataFrame:
    """One of the built-in seed lookups as a local relation, whose size the planner knows."""
    return spark.sql(seed_values_sql(name, "string")[1:-1])


def read_seed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Typed CSV seed from shared storage (header row, explicit schema, no inference)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def seed_values_sql(name: str, text: str = "varchar") -> str:
    """A built-in lookup as a SQL ``VALUES`` relation; ``text`` names the string type."""
    cols = [c.strip().split(" ")[0] for c in SEED_SCHEMAS[name].split(",")]
    types = [c.strip().split(" ", 1)[1] for c in SEED_SCHEMAS[name].split(",")]

    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t.replace('string', text)})"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v} AS {t.replace('string', text)})"

    body = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in SEED_ROWS[name])
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"
