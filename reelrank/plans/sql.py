"""SQL text of the table bindings, shared by the DuckDB oracle strings.

These mirror ``reelrank.sources.tables`` exactly; any change must be made
in both places.
"""

RATINGS_SQL = (
    "select o_custkey as uid, l_partkey as mid, "
    "cast(ceil(l_quantity / 5) / 2.0 as double) as score, "
    "o_orderdate as ts, l_orderkey as ok, l_linenumber as ln "
    "from lineitem join orders on l_orderkey = o_orderkey"
)

MOVIES_SQL = (
    "select p_partkey as mid, p_name as name, "
    "concat_ws('|', p_type, replace(p_name, ' ', '|')) as genres from part"
)

MOVIES_FULL_SQL = (
    "select p_partkey as mid, p_name as name, p_type as descri, "
    "concat(cast(p_size as varchar), ' minutes') as timelog, p_brand as issue, "
    "'' as shoot, '' as language, "
    "concat_ws('|', p_type, replace(p_name, ' ', '|')) as genres, "
    "replace(p_name, ' ', '|') as actors, p_brand as directors from part"
)

TAGS_SQL = (
    "select o_custkey as uid, l_partkey as mid, o_orderpriority as tag, "
    "cast(epoch(o_orderdate) as bigint) as timestamp "
    "from lineitem join orders on l_orderkey = o_orderkey"
)


def with_bindings(body: str) -> str:
    """Prefix a query with the R (ratings), M (movies), T (tags) CTEs."""
    return (f"with R as ({RATINGS_SQL}), M as ({MOVIES_SQL}), "
            f"MF as ({MOVIES_FULL_SQL}), T as ({TAGS_SQL}) {body}")


def values_list(items) -> str:
    return ", ".join("('" + s.replace("'", "''") + "')" for s in items)
