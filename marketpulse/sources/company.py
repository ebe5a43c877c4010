"""Company dimension (S1) and its fixed values.

The dimension is tiny and fixed-size, so joining posts to it is a broadcast
hash join; a caller-supplied dimension is size-checked before broadcasting
(see ``operators.broadcast``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketpulse.schemas import COMPANY_SCHEMA
from marketpulse.sources.literal import literal_frame

# --- Fixed values (must equal the original search setup) -------------------
# Search dictionary: (ticker, search keyword, sector), in load order.
# Keywords keep their double quotes: quoted = exact phrase, bare = all terms.
COMPANIES = [
    ("BAC", '"Bank of America"', "Banks"),
    ("WFC", '"Wells Fargo"', "Banks"),
    ("PNC", '"PNC Financial"', "Banks"),
    ("JPM", "JP Morgan Chase", "Banks"),
    ("C", "Citigroup", "Banks"),
    ("HON", "Honeywell", "Manufacturing"),
    ("BA", "Boeing", "Manufacturing"),
    ("CAT", "Caterpillar", "Manufacturing"),
    ("DE", "deere co", "Manufacturing"),
    ("MMM", '"3M co"', "Manufacturing"),
    ("ENPH", '"Enphase Energy"', "Clean Energy"),
    ("PLUG", '"Plug Power"', "Clean Energy"),
    ("VWDRY", '"Vestas Wind Systems"', "Clean Energy"),
    ("SEDG", '"Solaredge Technologies"', "Clean Energy"),
    ("FSLR", '"First Solar"', "Clean Energy"),
    ("COP", "ConocoPhillips", "Oil & Extraction"),
    ("EOG", '"EOG Resources Inc"', "Oil & Extraction"),
    ("PXD", '"Pioneer Natural Resources"', "Oil & Extraction"),
    ("MPC", '"Marathon Petroleum"', "Oil & Extraction"),
    ("DVN", '"Devon Energy"', "Oil & Extraction"),
    ("IVV", '"iShares Core S P 500 ETF"', "All"),
    ("KBWB", '"Invesco KBW Bank ETF"', "Banks"),
    ("ICLN", '"iShares Global Clean Energy"', "Clean Energy"),
    ("XLI", '"SPDR Select Sector Fund"', "Manufacturing"),
    ("IEO", '"iShares U.S. Oil"', "Oil & Extraction"),
]
# The earlier ingestion variants searched only the first 20 of these.
EARLY_COMPANY_COUNT = 20

# Sector CASE of the earliest ingestion variant, arms in their original order,
# quirks included: 'BA ' has a trailing space, 'VWS' and 'DNV' match no key.
SECTOR_CASE_ARMS = [
    ("BNKS", "Banks"),
    ("BAC", "Banks"),
    ("WFC", "Banks"),
    ("PNC", "Banks"),
    ("JPM", "Banks"),
    ("C", "Banks"),
    ("XLI", "Manufacturing"),
    ("HON", "Manufacturing"),
    ("BA ", "Manufacturing"),
    ("CAT", "Manufacturing"),
    ("DE", "Manufacturing"),
    ("MMM", "Manufacturing"),
    ("ICLN", "Clean Energy"),
    ("ENPH", "Clean Energy"),
    ("PLUG", "Clean Energy"),
    ("VWS", "Clean Energy"),
    ("SEDG", "Clean Energy"),
    ("FSLR", "Clean Energy"),
    ("IEO", "Oil & Extraction"),
    ("COP", "Oil & Extraction"),
    ("EOG", "Oil & Extraction"),
    ("PXD", "Oil & Extraction"),
    ("MPC", "Oil & Extraction"),
    ("DNV", "Oil & Extraction"),
]
SECTOR_CASE_DEFAULT = "na"

# Posts whose text contains this phrase are noise (a stadium, not the bank).
NOISE_PHRASE = "Bank of America Stadium"
# Page size of the search source and the per-key cap of the capped variant.
PAGE_SIZE = 100
PAGE_CAP = 100
# ---------------------------------------------------------------------------


def company_dim(spark: SparkSession, entries=None) -> DataFrame:
    """Dimension ``(ordinal, ticker, keyword, sector)`` from literal entries.

    ``entries`` are ``(ticker, keyword, sector)`` or ``(ticker, keyword)``
    tuples (the sector-less early variant); default is ``COMPANIES``.
    """
    rows = []
    for i, entry in enumerate(COMPANIES if entries is None else entries):
        ticker, keyword = entry[0], entry[1]
        sector = entry[2] if len(entry) > 2 else None
        rows.append((i, ticker, keyword, sector))
    return literal_frame(spark, rows, COMPANY_SCHEMA)
