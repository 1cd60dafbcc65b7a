"""Made-up locations: every canonical feeder, three of them on the map, two at one place."""

from faultline.functions.rules import CANONICAL_FEEDERS

PLACED = {
    "SAMONDA": (7.25, 3.5, 2.0, "high", "urban", 'mast "A", north'),
    "ROM": (7.25, 3.5, 2.0, "low", "urban", "same mast"),
    "APETE": (7.27, 3.5, 1.0, "medium", "rural", "a bridge"),
}
PLACES = [
    (name, *PLACED.get(name, (None, None, None, "unlocated", None, "not known")))
    for name in CANONICAL_FEEDERS
]
