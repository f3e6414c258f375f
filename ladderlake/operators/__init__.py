from ladderlake.operators.drift import (
    drift_across,
    field_types,
    record_drift,
    record_schemas,
    union_widened,
)
from ladderlake.operators.lookup import (
    lookup_chain,
    matches_of_players,
    recent_per_player,
    resolve_names,
)
from ladderlake.operators.nested import explode_fields, match_facts
from ladderlake.operators.profile import (
    columns_of_type,
    count_by,
    describe,
    describe_by,
    describe_strings,
    distinct_count,
    null_profile,
    row_count,
    schema_drift,
    schema_report,
)
from ladderlake.operators.ranking import number_rows, top_n, top_players
from ladderlake.operators.sets import distinct_values, preview, union_by_name, union_by_position
from ladderlake.operators.states import (
    merge_states,
    profile_figures,
    profile_states,
    update_profile,
)

__all__ = [
    "columns_of_type",
    "count_by",
    "describe",
    "describe_by",
    "describe_strings",
    "distinct_count",
    "distinct_values",
    "drift_across",
    "explode_fields",
    "field_types",
    "lookup_chain",
    "match_facts",
    "matches_of_players",
    "merge_states",
    "null_profile",
    "number_rows",
    "preview",
    "profile_figures",
    "profile_states",
    "recent_per_player",
    "record_drift",
    "record_schemas",
    "resolve_names",
    "row_count",
    "schema_drift",
    "schema_report",
    "top_n",
    "top_players",
    "union_by_name",
    "union_by_position",
    "union_widened",
    "update_profile",
]
