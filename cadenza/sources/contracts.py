"""What the feed files must contain, and the names the tables use for it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from cadenza.functions.dates import back

HISTORY_DAYS = 14  # fixed values: dates per daily file, and the age of the newest one
FEED_LAG = 2

# File column -> table column, home-territory daily artist file.
ARTIST_COLUMNS = {
    "TW Rank": "tw_rank",
    "LW Rank": "lw_rank",
    "Artist": "artist",
    "UnifiedArtistID": "unified_artist_id",
    "TW On-Demand Audio Streams": "tw_oda_streams",
    "LW On-Demand Audio Streams": "lw_oda_streams",
    "L2W_On_Demand_Audio_Streams": "l2w_oda_streams",
    "Weekly %change On-Demand Audio Streams": "weekly_pct_chg_oda_streams",
    "YTD On-Demand Audio Streams": "ytd_oda_streams",
    "RTD On-Demand Audio Streams": "rtd_oda_streams",
    "WTD Building ODA (Friday-Thursday)": "wtd_building_oda",
    "7-day rolling ODA": "tw_rolling_oda",
    "pre-7 day rolling oda": "lw_rolling_oda",
    "TW Album Sales": "tw_album_sales",
    "YTD Album Sales": "ytd_album_sales",
    "RTD Album Sales": "rtd_album_sales",
    "TW Digital Track Sales": "tw_digital_track_sales",
    "YTD Digital Track Sales": "ytd_digital_track_sales",
    "RTD Digital Track Sales": "rtd_digital_track_sales",
    "TW On-Demand Video": "tw_odv",
    "LW On-Demand Video": "lw_odv",
    "YTD On-Demand Video": "ytd_odv",
    "RTD On-Demand Video": "rtd_odv",
}

# The same for the daily song file.
SONG_COLUMNS = {
    "TW Rank": "tw_rank",
    "LW Rank": "lw_rank",
    "Artist": "artist",
    "Title": "title",
    "Unified Song Id": "unified_song_id",
    "Label Abbrev": "label",
    "CoreGenre": "core_genre",
    "Release_date": "release_date",
    "Top ISRC": "isrc",
    "TW On-Demand Audio Streams": "tw_oda_streams",
    "LW On-Demand Audio Streams": "lw_oda_streams",
    "L2W_On_Demand_Audio_Streams": "l2w_oda_streams",
    "Weekly %change On-Demand Audio Streams": "weekly_pct_chg_oda_streams",
    "YTD On-Demand Audio Streams": "ytd_oda_streams",
    "RTD On-Demand Audio Streams": "rtd_oda_streams",
    "RTD On-Demand Audio Streams - Premium": "rtd_oda_streams_premium",
    "RTD On-Demand Audio Streams - Ad Supported": "rtd_oda_streams_ad_supported",
    "WTD Building ODA (Friday-Thursday)": "wtd_building_oda",
    "7-day Rolling ODA": "tw_rolling_oda",
    "pre-7days rolling ODA": "lw_rolling_oda",
    "TW Digital Track Sales": "tw_digital_track_sales",
    "YTD Digital Track Sales": "ytd_digital_track_sales",
    "ATD Digital Track Sales": "atd_digital_track_sales",
    "TW On-Demand Video": "tw_odv",
    "LW On-Demand Video": "lw_odv",
    "YTD On-Demand Video": "ytd_odv",
    "ATD On-Demand Video": "atd_odv",
}

# Suffixes of the three daily series of a song file.
SERIES_SUFFIX = {"streams": " - Total ODA", "premium": " - Premium ODA", "ad_supported": " - Ad Supported ODA"}

# Columns of the weekly territory files; lifetime columns carry a year.
WEEKLY_COLUMNS = {
    "Country": "country",
    "Digital Song Sales - TP": "digital_song_sales_tw",
    "Streaming On-Demand Total - TP": "tw_streams",
    "Streaming On-Demand Total - % Change LP": "pct_chg",
    "Streaming On-Demand Total - LP": "lw_streams",
    "Streaming On-Demand Total - YTD": "ytd_streams",
}
LIFETIME_PREFIX = "Streaming On-Demand Total - ATD"

# Columns of the daily territory files.
DAY_COLUMN = "Streaming On-Demand Total - Current Day"
PRIOR_DAY_COLUMN = "Streaming On-Demand Total - Prior Day"

# The territories of the feed, by region.
TERRITORIES = {
    "eu": [
        "austria", "belgium", "croatia", "czech_republic", "denmark", "finland", "france", "germany", "iceland",
        "ireland", "italy", "luxembourg", "netherlands", "norway", "poland", "portugal", "spain", "sweden",
        "switzerland", "united_kingdom",
    ],
    "ne_asia": ["japan", "korea"],
    "se_asia": [
        "australia", "hong_kong", "indonesia", "malaysia", "new_zealand", "philippines", "singapore", "taiwan",
        "thailand", "vietnam",
    ],
    "lat_am": ["argentina", "bolivia", "brazil", "chile", "colombia", "ecuador", "mexico", "peru"],
    "emerging": ["greece", "hungary", "india", "romania", "slovakia", "south_africa", "turkey"],
}


class ContractError(ValueError):
    """A feed file lacks a required column."""


def history_dates(run_date: dt.date) -> list[dt.date]:
    """The dates a daily file must hold, newest first."""
    return [back(run_date, FEED_LAG + i) for i in range(HISTORY_DAYS)]


def recent_date(run_date: dt.date) -> dt.date:
    """The as-of date of a run: the newest date its files hold."""
    return back(run_date, FEED_LAG)


def _header(d: dt.date) -> str:
    return d.strftime("%m/%d/%Y")


def artist_contract(run_date: dt.date) -> list[str]:
    return [*ARTIST_COLUMNS, *(_header(d) for d in history_dates(run_date))]


def song_contract(run_date: dt.date) -> list[str]:
    daily = [_header(d) + s for d in history_dates(run_date) for s in SERIES_SUFFIX.values()]
    return [*SONG_COLUMNS, *daily]


def check_columns(df: DataFrame, required: Sequence[str], what: str) -> DataFrame:
    """Fail before any job runs when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"{what} file lacks: {', '.join(missing)}")
    return df
