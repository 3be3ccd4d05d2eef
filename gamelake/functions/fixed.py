"""Fixed values that must equal the reference's for right results.

FIXED VALUES (accepted enumerations from the staging contracts, segment limits and
freshness SLAs). Kept together, in natural order, as plain text.
"""

GAME_MODES = ["public", "custom", "ranked", "kill_your_friends", "ltm_lights_out", "ltm_2v8"]

# modes the generator marks as excluded from balance analytics
EXCLUDED_MODES = ["custom", "kill_your_friends", "ltm_lights_out", "ltm_2v8"]

SESSION_ACTIONS = [
    "login", "logout", "queue_join", "queue_cancel", "match_start", "match_end",
    "store_visit", "store_purchase", "loadout_change", "friend_invite", "rift_claim",
    "bloodweb_spend", "settings_change",
]

PLATFORMS = ["steam", "ps5", "ps4", "xbox_series", "xbox_one", "switch", "epic", "windows_store"]

REGIONS = ["us-east-1", "us-west-2", "eu-west-1", "eu-central-1", "ap-northeast-1",
           "ap-southeast-2", "sa-east-1"]

ITEM_TYPES = ["cosmetic_head", "cosmetic_body", "cosmetic_weapon", "dlc_chapter", "dlc_killer",
              "dlc_survivor", "rift_pass", "auric_cells_pack", "bundle", "charm"]

CURRENCIES = ["auric_cells", "iridescent_shards", "usd", "eur", "cad", "gbp"]

CHURN_SEGMENTS = ["active", "at_risk", "dormant", "churned"]

# recency limits (days): <=7 active, <=14 at_risk, <=30 dormant, else churned
CHURN_LIMITS = [7, 14, 30]

# MMR limits: <500 new, <1000 casual, <1500 core, else hardcore
MMR_LIMITS = [500, 1000, 1500]
MMR_SEGMENTS = ["new", "casual", "core", "hardcore"]

# kill-rate limits: <0.40, <0.50, <=0.60, <=0.70, else
BALANCE_RATINGS = ["strongly_survivor_sided", "survivor_sided", "balanced", "killer_sided",
                   "strongly_killer_sided"]

# spend buckets for the lifetime-value report
LTV_BUCKETS = ["$0 (Free)", "$1 - $9", "$10 - $49", "$50 - $99", "$100+"]

# freshness SLA per source: (warn hours, error hours)
FRESHNESS_SLA = {
    "match_completed": (1, 2),
    "session_event": (1, 2),
    "store_transaction": (2, 4),
    "mmr_update": (2, 4),
    "player_registration": (4, 8),
    "progression_event": (2, 4),
}

# retention offsets (days after the cohort date)
RETENTION_DAYS = [1, 7, 30]

# look-back for incremental staging loads (days)
INCREMENTAL_LOOKBACK_DAYS = 3

# trailing windows of active players (days)
MAU_DAYS = 30

# maximum lateness of an event (hours), used as the streaming watermark
MAX_LATENESS_HOURS = 48

# required top-level keys per raw event type (schema-drift monitor)
EXPECTED_KEYS = {
    "match_completed": ["event_type", "event_id", "timestamp", "match_id", "duration_seconds",
                        "map_id", "game_mode", "killer", "survivors"],
    "session_event": ["event_type", "event_id", "timestamp", "player_id", "session_id", "action",
                      "platform", "region", "client_version"],
    "store_transaction": ["event_type", "event_id", "timestamp", "player_id", "transaction_id",
                          "item_id", "item_type", "currency", "amount", "amount_usd"],
}
