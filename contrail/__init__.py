"""contrail: flight-traffic analytics as Spark DataFrame plans.

The public functions, grouped as in the README; every one takes and returns
DataFrames (sinks and jobs write and return run ids).
"""

from contrail.functions.geo import haversine_km, path_length_km, register_sql_functions
from contrail.functions.timefmt import duration, epoch_seconds, epoch_to_ts
from contrail.operators.clean import (clean_flights, drop_columns, drop_null_keys, drop_sentinel_keys,
                                      epoch_columns_to_ts, flatten_struct, normalize_blanks, null_ratios,
                                      prune_sparse)
from contrail.operators.current import active_flights, current_flights, current_versions, with_current_flag
from contrail.operators.dedup import dedup_latest, top_k_per_group
from contrail.operators.dims import bounded_broadcast, join_dimension
from contrail.operators.enrich import enrich
from contrail.operators.indicators import (airline_counts, airport_in_out, avg_distance, longest_by_distance,
                                           longest_by_time, manufacturer_counts, models_by_country, regional_counts,
                                           route_distance, top_k, top_longest_by_distance, top_longest_by_time,
                                           trail_distance)
from contrail.operators.nested import explode_flatten, flatten
from contrail.operators.scd2 import scd2_as_of, scd2_history, scd2_init, scd2_merge
from contrail.operators.sequence import with_neighbor
from contrail.sources.feeds import ingest_json, ingest_to_bronze, load_schema, read_feed, stamp_extract
from contrail.sources.scd2_table import read_scd2, upsert_scd2
from contrail.sources.sinks import latest_run, read_table, read_version, write_run, write_table, write_version

__version__ = "0.1.0"
