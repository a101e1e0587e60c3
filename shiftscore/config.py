"""Scoring parameters.

Every default below is a fixed value of the lead-scoring job being rebuilt;
changing one changes the scores.  They are kept together so a user can pass a
``ScoringConfig(...)`` with other lists or weights without touching the plans.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference job's values for identical
# results; they are stated as written there, in their original order.
# ---------------------------------------------------------------------------

# Keywords matched (case-insensitive substring) in the to/from address of the
# customer's first order on the last order date.  "Sociecty" is misspelt in the
# original list and is kept that way.
ORDER_ADDRESS_KEYWORDS = (
    "Apartment", "Housing", "Sociecty", "Tower", "Block", "Prestige", "Brigade",
    "Sobha", "Godrej", "Mahindra", "Birla", "Ark", "Countryside", "Lodha",
    "Runwal", "Kalpataru", "Dosti", "Wadhwa", "Piramal", "Jain", "Marg",
    "Unitech", "DLF", "Raheja", "DGR", "Adarsh", "Ashiana", "Parsvnath",
    "Nagpal", "Fortune", "Ramky", "Salapuria", "Sri Aditya", "Jayabheri",
    "Manbhum", "Rustomjee",
)

# Keywords matched in the lead's pickup address.
LEAD_PICKUP_KEYWORDS = (
    "Housing", "Apartment", "Sociecty", "Tower", "Block", "Prestige", "Brigade",
    "Sobha", "Godrej", "Mahindra", "Birla", "Ark", "Countryside", "Lodha",
    "Runwal", "Kalpataru", "Dosti", "Wadhwa", "Piramal", "Jain", "Marg",
    "Unitech", "DLF", "Raheja", "DGR", "Adarsh", "Ashiana", "Parsvnath",
    "Nagpal", "Fortune", "Ramky", "Salapuria", "Sri Aditya", "Jayabheri",
    "Manbhum", "Rustomjee",
)

# Keywords matched in the lead's drop address.  The original drop list has a
# TAB between "Sri" and "Aditya", so "Sri Aditya" with a space does not match.
LEAD_DROP_KEYWORDS = (
    "Housing", "Apartment", "Sociecty", "Tower", "Block", "Prestige", "Brigade",
    "Sobha", "Godrej", "Mahindra", "Birla", "Ark", "Countryside", "Lodha",
    "Runwal", "Kalpataru", "Dosti", "Wadhwa", "Piramal", "Jain", "Marg",
    "Unitech", "DLF", "Raheja", "DGR", "Adarsh", "Ashiana", "Parsvnath",
    "Nagpal", "Fortune", "Ramky", "Salapuria", "Sri\tAditya", "Jayabheri",
    "Manbhum", "Rustomjee",
)

# Installed-app categories, in the original order (category -> app names).
APP_CATEGORIES = (
    ("competitor", ("Packers & Movers by NoBroker", "LYNK")),
    ("luxury", ("Netflix", "LinkedIn", "Quora", "Spotify", "CRED")),
    ("daily convenience", ("Swiggy", "Ola", "Uber", "Zomato")),
    ("E-Commerce", ("Flipkart", "Amazon", "Myntra", "Curefit", "Jiomart", "Snapdeal")),
    ("house_shifting", ("ADDA - The Apartment Super App", "MyGate", "JioGate", "NoBrokerHOOD")),
)

# Device models compared literally (an IN list, not LIKE patterns) for the
# premium-device flag, plus the platform that always counts as premium.
PREMIUM_DEVICE_MODELS = ("SM-G9%", "Pixel%", "ONEPLUS%", "SM-N9%")
PREMIUM_PLATFORM = "iOS"

# Inventory vehicle ids that count as a helper-category attempt.
HELPER_VEHICLE_IDS = (96, 98, 99)

# Completed order status.
COMPLETED_ORDER_STATUS = 4

# Shift from UTC to India wall time: 5.5 hours.
LOCAL_OFFSET_SECONDS = 19800

# Sign-up attribution value that counts as paid.
PAID_ATTRIBUTION = "attribution_paid"

# Trip keyword labels.
KEYWORD_TRIP = "house_shifting_keyword_trip"
OTHER_TRIP = "other_keyword_used"

# Lead channel weights.
HIGH_SOURCES = ("app", "website", "CC Leads", "app_banner")    # weight 5
MID_SOURCES = ("Missed call", "Whatsapp")                      # weight 3, others 1
SOURCE_WEIGHTS = (5, 3, 1)

# Source whose leads take the days-to-move from the WhatsApp answer.
WHATSAPP_OVERRIDE_SOURCE = "WhatsApp"
WHATSAPP_DAYS = (("NOW", 0), ("Within 2 Days", 1), ("After 2 Days", 2))

# Call-sheet statuses that mean "not yet called".
UNCALLED_STATUSES = ("Call not done", "")

# Base-score weights per flag.
BASE_WEIGHTS = (
    ("lead_channel_attribution", 1),
    ("competitor_apps_flag", 3),
    ("luxury_apps_flag", 5),
    ("ecommerce_apps_flag", 3),
    ("daily_convenience_apps_flag", 3),
    ("house_shifting_apps_flag", 5),
    ("helper_flag", 1),
    ("lto_0_flag", 1),
    ("mobile_device_type", 5),
)

# Weight of the society/address flag in the final score.
SOCIETY_WEIGHT = 3


@dataclass(frozen=True)
class ScoringConfig:
    order_address_keywords: tuple = ORDER_ADDRESS_KEYWORDS
    lead_pickup_keywords: tuple = LEAD_PICKUP_KEYWORDS
    lead_drop_keywords: tuple = LEAD_DROP_KEYWORDS
    app_categories: tuple = APP_CATEGORIES
    premium_device_models: tuple = PREMIUM_DEVICE_MODELS
    premium_platform: str = PREMIUM_PLATFORM
    # Opt-in: treat premium_device_models as LIKE prefixes instead of literals.
    premium_models_as_patterns: bool = False
    helper_vehicle_ids: tuple = HELPER_VEHICLE_IDS
    completed_status: int = COMPLETED_ORDER_STATUS
    local_offset_seconds: int = LOCAL_OFFSET_SECONDS
    paid_attribution: str = PAID_ATTRIBUTION
    base_weights: tuple = BASE_WEIGHTS
    society_weight: int = SOCIETY_WEIGHT
    # Key sets proven to have at most this many rows are broadcast (as longs
    # and short texts, tens of megabytes); larger ones are shuffled.
    broadcast_key_limit: int = 2_000_000
    # Beyond that, big relations are cut before their shuffle by a filter of
    # this many hash values (2 million words of 64 bits are broadcast at most); 0 is none.
    key_filter_slots: int = 1 << 27

    @property
    def app_names(self) -> tuple:
        return tuple(n for _, names in self.app_categories for n in names)


DEFAULT = ScoringConfig()
