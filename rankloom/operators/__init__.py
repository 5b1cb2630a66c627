"""DataFrame to DataFrame steps of the star and the mart."""

from rankloom.operators.best import best_per_group
from rankloom.operators.defaults import fill_defaults
from rankloom.operators.dimensions import country_dim, date_dim, datetime_dim, player_dim
from rankloom.operators.facts import rankings
from rankloom.operators.incremental import first_brought, new_dates, new_datetimes, only_new
from rankloom.operators.numbering import number_rows
from rankloom.operators.preview import preview
from rankloom.operators.profile import column_profile, profile
from rankloom.operators.records import json_records
from rankloom.operators.tagged import records_of, stage_tagged, tag_records, tag_rows

__all__ = [
    "best_per_group",
    "column_profile",
    "country_dim",
    "date_dim",
    "datetime_dim",
    "fill_defaults",
    "first_brought",
    "json_records",
    "new_dates",
    "new_datetimes",
    "number_rows",
    "only_new",
    "player_dim",
    "preview",
    "profile",
    "rankings",
    "records_of",
    "stage_tagged",
    "tag_records",
    "tag_rows",
]
