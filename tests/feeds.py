"""Small sample feeds with known results."""

from spanledger.schemas import OPEN_END as OPEN
from spanledger.schemas import STAGED_CONTRACTS
from spanledger.sources.readers import inline_rows


def staged(spark, feed):
    return inline_rows(spark, feed, STAGED_CONTRACTS)


def _two(contract, territory, ext, amount, first_end="2022-12-31", second_start="2023-01-01"):
    return [
        (contract, territory, ext, amount, "2023-03-15", "2022-01-01", first_end),
        (contract, territory, ext, amount, "2023-03-15", second_start, OPEN),
    ]


# Six contracts in two contiguous pieces each.
CLEAN_DAY1 = (
    _two(1, 100, "EXT1001", "500.00") + _two(2, 100, "EXT1002", "750.00") + _two(1, 101, "EXT1011", "600.00")
    + _two(2, 101, "EXT1012", "900.00") + _two(1, 102, "EXT1021", "1000.00") + _two(2, 102, "EXT1022", "1200.00")
)
CLEAN_DAY2 = [
    (1, 100, "EXT1001", "550.00", "2023-03-16", "2023-01-01", OPEN),
    (2, 101, "EXT1012", "950.00", "2023-03-16", "2023-01-01", OPEN),
    (3, 100, "EXT1003", "800.00", "2023-03-16", "2023-01-01", OPEN),
    (3, 102, "EXT1023", "1100.00", "2023-03-16", "2023-01-01", OPEN),
]
# The same contracts, one with a gap in July 2022 and one with an overlap.
FRAGMENTED_DAY1 = (
    _two(1, 100, "EXT1001", "500.00") + _two(2, 100, "EXT1002", "750.00") + _two(1, 101, "EXT1011", "600.00")
    + _two(2, 101, "EXT1012", "900.00", "2022-06-30", "2022-08-01")
    + _two(1, 102, "EXT1021", "1000.00", "2022-12-31", "2022-07-01") + _two(2, 102, "EXT1022", "1200.00")
)
FRAGMENTED_DAY2 = [
    (1, 100, "EXT1001", "550.00", "2023-03-16", "2023-01-01", OPEN),
    (3, 100, "EXT1003", "800.00", "2023-03-16", "2023-01-01", OPEN),
    (3, 101, "EXT1013", "650.00", "2023-03-16", "2023-01-01", "2023-06-30"),
    (3, 101, "EXT1013", "650.00", "2023-03-16", "2023-07-01", "2023-12-31"),
    (3, 101, "EXT1013", "650.00", "2023-03-16", "2024-01-01", OPEN),
]
