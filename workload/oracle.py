"""The same results as plain SQL over the given tables, for DuckDB."""

from __future__ import annotations

from stateloom.schemas import MAX_BLOCK, SOURCES, ZERO_WORD
from workload.adapter import CHUNKS, FORKS, VERSIONS, VIEWS

ORACLE: dict[str, str] = {}


def _latest(name: str) -> str:
    """Newest copy per key of a view with a version."""
    spec, version = SOURCES[name], VERSIONS[name]
    keys = ", ".join(spec.keys)
    values = ", ".join(
        f"max_by({c}, {version}) AS {c}" for c in spec.schema.fieldNames() if c not in spec.keys
    )
    return f"SELECT {keys}, {values} FROM ({VIEWS[name].sql()}) raw GROUP BY {keys}"


_NET = (
    "slots_set - slots_cleared AS net_slots, (slots_set - slots_cleared) * 64 AS net_slots_bytes"
)
_SET = f"count(*) FILTER (WHERE from_value = '{ZERO_WORD}' AND to_value <> '{ZERO_WORD}')"
_CLEARED = f"count(*) FILTER (WHERE from_value <> '{ZERO_WORD}' AND to_value = '{ZERO_WORD}')"


def _events(*parts: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT lower({address}) AS address, block_number,"
        f" lower(transaction_hash) AS transaction_hash FROM c_{name}"
        for name, address in parts
    )


_DIFFS = (
    ("balance_diffs", "address"),
    ("storage_diffs", "address"),
    ("nonce_diffs", "address"),
    ("contracts", "contract_address"),
)
_READS = (
    ("balance_reads", "address"),
    ("nonce_reads", "address"),
    ("storage_reads", "contract_address"),
)


def _per_block(events: str) -> str:
    return (
        "SELECT e.address, e.block_number, count(DISTINCT e.transaction_hash) AS tx_count,"
        f" max(t.transaction_index) AS last_tx_index FROM {events} e"
        " JOIN tx t ON e.transaction_hash = t.transaction_hash GROUP BY e.address, e.block_number"
    )


_SUCCEEDED = "transaction_hash IN (SELECT transaction_hash FROM tx)"
_POSITION = "row(block_number, transaction_index, internal_index, value)"


def _positioned(read_index: int) -> str:
    return (
        "SELECT lower(address) AS address, slot AS slot_key, block_number, transaction_index,"
        " internal_index, to_value AS value FROM c_storage_diffs UNION ALL"
        f" SELECT address, slot_key, block_number, {read_index}, {read_index}, value"
        f" FROM slot_reads WHERE {_SUCCEEDED}"
    )


_CTES: dict[str, str] = {
    **{f"c_{name}": view.sql() for name, view in VIEWS.items() if name not in VERSIONS},
    **{f"c_{name}": _latest(name) for name in VERSIONS},
    "tx": "SELECT DISTINCT lower(transaction_hash) AS transaction_hash, transaction_index"
    " FROM c_transaction WHERE success",
    "diffs": _events(*_DIFFS),
    "reads": _events(*_READS),
    "accesses": _events(*_DIFFS, *_READS),
    "slot_writes": "SELECT lower(address) AS address, slot AS slot_key, block_number,"
    " to_value AS value, lower(transaction_hash) AS transaction_hash FROM c_storage_diffs",
    "slot_reads": "SELECT lower(contract_address) AS address, slot AS slot_key, block_number,"
    " value, lower(transaction_hash) AS transaction_hash FROM c_storage_reads",
    "slot_accesses": "SELECT * FROM slot_writes UNION ALL SELECT * FROM slot_reads",
    "address_diffs": _per_block("diffs"),
    "address_reads": _per_block("reads"),
    "address_first_access": f"SELECT address, min(block_number) AS block_number,"
    f" {MAX_BLOCK} - min(block_number) AS version FROM accesses WHERE {_SUCCEEDED} GROUP BY address",
    "address_last_access": "SELECT address, max(block_number) AS block_number,"
    f" false AS is_deleted FROM accesses WHERE {_SUCCEEDED} GROUP BY address",
    "first_positions": _positioned(MAX_BLOCK),
    "last_positions": _positioned(0),
    "slot_first_access_ordered": "SELECT address, slot_key, min(block_number) AS block_number,"
    f" min_by(value, {_POSITION}) AS value, {MAX_BLOCK} - min(block_number) AS version"
    " FROM first_positions GROUP BY address, slot_key",
    "slot_last_access_ordered": "SELECT address, slot_key, max(block_number) AS block_number,"
    f" max_by(value, {_POSITION}) AS value FROM last_positions GROUP BY address, slot_key",
    "slot_first_access_success": "SELECT address, slot_key, min(block_number) AS block_number,"
    f" min_by(value, row(block_number, value)) AS value, {MAX_BLOCK} - min(block_number) AS version"
    f" FROM slot_accesses WHERE {_SUCCEEDED} GROUP BY address, slot_key",
    "slot_last_access_success": "SELECT address, slot_key, max(block_number) AS block_number,"
    " max_by(value, row(block_number, value)) AS value"
    f" FROM slot_accesses WHERE {_SUCCEEDED} GROUP BY address, slot_key",
    "slot_counts": f"SELECT lower(address) AS address, block_number, {_CLEARED} AS slots_cleared,"
    f" {_SET} AS slots_set FROM c_storage_diffs WHERE lower(transaction_hash) IN"
    " (SELECT transaction_hash FROM tx) GROUP BY lower(address), block_number",
    "address_slots_stat_per_block": f"SELECT *, {_NET} FROM slot_counts",
    "block_counts": f"SELECT block_number, {_CLEARED} AS slots_cleared, {_SET} AS slots_set"
    " FROM c_storage_diffs WHERE lower(transaction_hash) IN (SELECT transaction_hash FROM tx)"
    " GROUP BY block_number",
    "block_slots_stat": f"SELECT *, {_NET} FROM block_counts",
    "rolled_up": "SELECT block_number, cast(sum(slots_cleared) AS bigint) AS slots_cleared,"
    " cast(sum(slots_set) AS bigint) AS slots_set"
    " FROM address_slots_stat_per_block GROUP BY block_number",
    "block_slots_stat_rollup": f"SELECT *, {_NET} FROM rolled_up",
    "destructs": "SELECT lower(action_from) AS address, block_number,"
    " lower(transaction_hash) AS transaction_hash FROM c_traces WHERE action_type = 'suicide'",
    "emptied": "SELECT lower(action_to) AS address, block_number,"
    " lower(transaction_hash) AS transaction_hash FROM c_traces"
    " WHERE action_type = 'suicide' AND action_value = '0'",
    "early_destructs": f"SELECT * FROM destructs WHERE block_number < {FORKS.same_tx_destruct}"
    f" UNION ALL SELECT * FROM emptied WHERE block_number < {FORKS.state_clearing}",
    "pre_fork_destructs": "SELECT e.address, e.block_number, e.transaction_hash,"
    " max(t.transaction_index) AS transaction_index FROM early_destructs e"
    " JOIN tx t ON e.transaction_hash = t.transaction_hash"
    " GROUP BY e.address, e.block_number, e.transaction_hash",
    "created": "SELECT DISTINCT lower(contract_address) AS address,"
    " lower(transaction_hash) AS transaction_hash, true AS created FROM c_contracts",
    "flagged": "SELECT d.address, d.block_number, d.transaction_hash,"
    " c.created IS NOT NULL AS is_same_tx FROM destructs d LEFT JOIN created c"
    " ON d.address = c.address AND d.transaction_hash = c.transaction_hash",
    "post_fork_destructs": "SELECT f.address, f.block_number, f.transaction_hash,"
    " max(t.transaction_index) AS transaction_index, bool_or(f.is_same_tx) AS is_same_tx"
    " FROM flagged f JOIN tx t ON f.transaction_hash = t.transaction_hash"
    f" WHERE f.block_number >= {FORKS.same_tx_destruct}"
    " GROUP BY f.address, f.block_number, f.transaction_hash",
    "appearance_flags": "SELECT lower(address) AS address, block_number,"
    " lower(transaction_hash) AS transaction_hash,"
    " max(CASE WHEN relationship = 'create' THEN 1 ELSE 0 END) = 1 AS has_create,"
    " max(CASE WHEN relationship = 'suicide' THEN 1 ELSE 0 END) = 1 AS has_suicide"
    " FROM c_address_appearances WHERE relationship IN ('create', 'suicide')"
    " GROUP BY lower(address), block_number, lower(transaction_hash)",
    "post_fork_destructs_appearances": "SELECT f.address, f.block_number, f.transaction_hash,"
    " t.transaction_index, f.has_create AS is_same_tx FROM appearance_flags f"
    " JOIN tx t ON f.transaction_hash = t.transaction_hash"
    f" WHERE f.has_suicide AND f.block_number >= {FORKS.same_tx_destruct}",
    "life_events": "SELECT address, block_number, transaction_index, false AS is_alive"
    " FROM pre_fork_destructs UNION ALL"
    " SELECT address, block_number, transaction_index, NOT is_same_tx FROM post_fork_destructs"
    " UNION ALL SELECT address, block_number, last_tx_index, true FROM address_diffs",
    "accounts_alive": "SELECT address, max(block_number) AS block_number,"
    " max_by(is_alive, row(block_number, transaction_index, NOT is_alive)) AS is_alive"
    " FROM life_events GROUP BY address",
    "last_block": f"SELECT max(block_number) AS last_block, max(block_number) // {CHUNKS} + 1 AS step"
    " FROM c_transaction",
    "reads_per_block": " UNION ALL ".join(
        f"SELECT block_number, '{name}' AS source, count(*) AS reads FROM c_{name}"
        " GROUP BY block_number"
        for name, _ in _READS
    ),
}


def _with(body: str) -> str:
    """Put the CTEs a statement needs, and those they need, in front of it."""
    needed: dict[str, None] = {}
    words = "".join(c if c.isalnum() or c == "_" else " " for c in body).split()

    def need(name: str) -> None:
        if name in needed:
            return
        text = "".join(c if c.isalnum() or c == "_" else " " for c in _CTES[name]).split()
        for inner in text:
            if inner in _CTES and inner != name:
                need(inner)
        needed[name] = None

    for word in words:
        if word in _CTES:
            need(word)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in needed) + "\n" + body


def _add(name: str, body: str) -> None:
    ORACLE[name] = _with(body)


_TABLES = (
    "address_diffs address_reads address_first_access address_last_access"
    " slot_first_access_ordered slot_last_access_ordered slot_first_access_success"
    " slot_last_access_success address_slots_stat_per_block block_slots_stat"
    " block_slots_stat_rollup pre_fork_destructs post_fork_destructs"
    " post_fork_destructs_appearances accounts_alive"
).split()

for _name in _TABLES:
    _add(_name, f"SELECT * FROM {_name}")

_add(
    "scan_block_range",
    "SELECT address, block_number, transaction_hash FROM c_balance_diffs"
    f" WHERE block_number BETWEEN {FORKS.state_clearing} AND {MAX_BLOCK}",
)
_add("latest_per_key", "SELECT * FROM c_storage_diffs")
_add("load_parquet_folder", "SELECT address FROM c_balance_diffs")
_add(
    "load_report",
    "SELECT cast(11 AS bigint) AS files, cast(9 AS bigint) AS loaded, cast(2 AS bigint) AS failed,"
    " cast(81.8 AS double) AS success_rate, count(*) AS rows FROM c_balance_diffs",
)
_add("write_block_facts", "SELECT * FROM address_diffs")
_add("upsert_keyed_state", "SELECT * FROM address_last_access")
_add(
    "hash_layout",
    "SELECT address, count(*) AS stored_rows, cast(1 AS bigint) AS partitions"
    " FROM address_reads GROUP BY address",
)
_add(
    "hash_layout_composite",
    "SELECT address, slot_key, count(*) AS stored_rows, cast(1 AS bigint) AS partitions"
    " FROM slot_accesses GROUP BY address, slot_key",
)
_add(
    "block_bucket_layout",
    "SELECT block_number, net_slots, block_number // 5000000 AS block_bucket FROM block_slots_stat",
)
_add(
    "normalize_hex",
    "SELECT lower(address) AS address, count(DISTINCT address) AS spellings, count(*) AS events"
    " FROM (SELECT address FROM c_balance_diffs UNION ALL SELECT address FROM c_nonce_diffs) raw"
    " GROUP BY lower(address)",
)
_add("filter_tx_success", "SELECT * FROM tx")
_add("filter_action", "SELECT * FROM emptied")
_add(
    "filter_relationship_in",
    "SELECT * FROM c_address_appearances WHERE relationship IN ('create', 'suicide')",
)
_add(
    "fork_window",
    f"SELECT *, CASE WHEN block_number < {FORKS.same_tx_destruct} THEN 'before' ELSE 'since' END"
    " AS era FROM destructs",
)
_add(
    "unify_access_columns",
    "SELECT *, 'write' AS kind FROM slot_writes UNION ALL SELECT *, 'read' AS kind FROM slot_reads",
)
_add(
    "source_sentinel",
    " UNION ALL ".join(
        "SELECT address, slot_key, block_number,"
        f" cast({index} AS bigint) AS transaction_index, cast({index} AS bigint) AS internal_index,"
        f" value, '{wanted}' AS wanted FROM slot_reads"
        for wanted, index in (("first", MAX_BLOCK), ("last", 0))
    ),
)
_add(
    "destruct_effect",
    "SELECT address, block_number, transaction_index, NOT is_same_tx AS is_alive"
    " FROM post_fork_destructs",
)
_add(
    "join_tx_index",
    "SELECT d.address, d.block_number, d.transaction_hash, t.transaction_index"
    " FROM diffs d JOIN tx t ON d.transaction_hash = t.transaction_hash",
)
_add("semi_tx_success", f"SELECT * FROM slot_accesses WHERE {_SUCCEEDED}")
_add("left_join_creation", "SELECT * FROM flagged")
_add("union_diffs", "SELECT * FROM diffs")
_add("union_reads", "SELECT * FROM reads")
_add("union_accesses", "SELECT * FROM accesses")
_add("union_storage_accesses", "SELECT * FROM slot_accesses")
_add("union_destructs", "SELECT * FROM early_destructs")
_add("union_life_events", "SELECT * FROM life_events")
_add(
    "agg_count_distinct",
    "SELECT address, block_number, count(DISTINCT transaction_hash) AS tx_count"
    " FROM diffs GROUP BY address, block_number",
)
_add("agg_max", "SELECT address, max(block_number) AS block_number FROM accesses GROUP BY address")
_add("agg_min", "SELECT address, min(block_number) AS block_number FROM accesses GROUP BY address")
_ADDRESS_TOTALS = (
    "SELECT address, cast(sum(slots_set) AS bigint) AS slots_set,"
    " cast(sum(slots_cleared) AS bigint) AS slots_cleared FROM slot_counts GROUP BY address"
)
_add("agg_sum", _ADDRESS_TOTALS)
_add("agg_count_if", _ADDRESS_TOTALS)
_add("agg_flag", "SELECT * FROM appearance_flags")
_add("agg_any_bool", "SELECT address, bool_or(is_same_tx) AS is_same_tx FROM flagged GROUP BY address")
_WRITE_POSITION = "row(block_number, transaction_index, internal_index, to_value)"
for _name, _pick in (("agg_argmin_tuple", "min_by"), ("agg_argmax_tuple", "max_by")):
    _add(
        _name,
        f"SELECT address, slot, {_pick}(to_value, {_WRITE_POSITION}) AS value"
        " FROM c_storage_diffs GROUP BY address, slot",
    )
for _name, _pick in (("agg_argmin_block", "min_by"), ("agg_argmax_block", "max_by")):
    _add(
        _name,
        f"SELECT address, slot_key, {_pick}(value, row(block_number, value)) AS value"
        " FROM slot_accesses GROUP BY address, slot_key",
    )
_add("agg_argmax_pessimistic", "SELECT address, is_alive FROM accounts_alive")
_add(
    "agg_mergeable",
    "SELECT 'first' AS kind, address, block_number, cast(NULL AS boolean) AS is_alive"
    " FROM address_first_access UNION ALL"
    " SELECT 'last', address, block_number, NULL FROM address_last_access UNION ALL"
    " SELECT 'alive', address, block_number, is_alive FROM accounts_alive",
)
_add(
    "slot_transition",
    "SELECT address, slot, block_number, internal_index, transaction_hash,"
    f" cast(CASE WHEN from_value = '{ZERO_WORD}' AND to_value <> '{ZERO_WORD}' THEN 1"
    f" WHEN from_value <> '{ZERO_WORD}' AND to_value = '{ZERO_WORD}' THEN -1 ELSE 0 END AS bigint)"
    " AS transition FROM c_storage_diffs",
)
_add(
    "inverse_version",
    f"SELECT transaction_hash, block_number, {MAX_BLOCK} - block_number AS version FROM c_transaction",
)
_add(
    "net_slots",
    "SELECT address, block_number, net_slots, net_slots_bytes FROM address_slots_stat_per_block",
)


def _last_blocks(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS source, cast(coalesce(max(block_number), 0) AS bigint) AS max_block"
        f" FROM c_{name}"
        for name in names
    )


_add("max_block", _last_blocks(SOURCES))
_add(
    "source_coverage",
    f"SELECT min(max_block) AS coverage FROM"
    f" ({_last_blocks([n for n, _ in _DIFFS if n != 'nonce_diffs'] + ['transaction'])})",
)
_add(
    "block_range",
    "SELECT 2 * any_value(step) AS start_block, min(max_block) AS end_block"
    f" FROM ({_last_blocks([n for n, _ in _READS] + ['transaction'])}), last_block",
)
_BOUND = "block_number <= (SELECT min(max_block) FROM ({}))"
_add(
    "run_incremental",
    "SELECT * FROM address_diffs WHERE "
    + _BOUND.format(_last_blocks([n for n, _ in _DIFFS] + ["transaction"])),
)


def _ledger(table: str, source: str, sources, extra: str) -> str:
    """Chunks of a table's range, with the rows each one stored."""
    return (
        "SELECT '{t}' AS \"table\", lower, least(lower + step - 1, last) AS upper, {extra}"
        " (SELECT count(*) FROM {source} WHERE block_number BETWEEN lower"
        " AND least(lower + step - 1, last)) AS rows, 'done' AS status"
        " FROM (SELECT unnest(generate_series(0, last, step)) AS lower, last, step"
        " FROM (SELECT min(max_block) AS last, any_value(step) AS step"
        " FROM ({blocks}), last_block))"
    ).format(t=table, source=source, extra=extra, blocks=_last_blocks(sources))


_BLOCKS = "least(lower + step - 1, last) - lower + 1 AS blocks,"
_EARLY = (
    f"CASE WHEN least(lower + step - 1, last) < {FORKS.state_clearing}"
    " THEN 'pre-EIP-161' ELSE '' END AS note,"
)
_add(
    "range_report",
    _ledger(
        "address_reads", "address_reads", [n for n, _ in _READS] + ["transaction"], _BLOCKS + " '' AS note,"
    )
    + " UNION ALL BY NAME "
    + _ledger("pre_fork_destructs", "pre_fork_destructs", ["traces", "transaction"], _BLOCKS + _EARLY),
)


def _totals(table: str, sources) -> str:
    bound = f"(SELECT min(max_block) FROM ({_last_blocks(sources)}))"
    return (
        f"SELECT '{table}' AS \"table\", cast(0 AS bigint) AS failed, {bound} + 1 AS blocks,"
        f" (SELECT count(*) FROM {table} WHERE block_number <= {bound}) AS rows"
    )


_add(
    "run_report",
    _totals("address_reads", [n for n, _ in _READS] + ["transaction"])
    + " UNION ALL BY NAME "
    + _totals("pre_fork_destructs", ["traces", "transaction"]),
)
for _name in ("refresh_tables", "refresh_pipeline", "refresh_after_failure"):
    _add(
        _name,
        "SELECT address, max(block_number) AS block_number,"
        " max_by(is_alive, row(block_number, transaction_index, NOT is_alive)) AS is_alive"
        " FROM life_events WHERE "
        + _BOUND.format(_last_blocks([n for n, _ in _DIFFS] + ["traces", "transaction"]))
        + " GROUP BY address",
    )
_RIGHT = f"FROM accesses WHERE {_SUCCEEDED} AND " + _BOUND.format(
    _last_blocks([n for n, _ in _DIFFS] + [n for n, _ in _READS] + ["transaction"])
)
_add(
    "refresh_after_correction",
    " UNION ALL ".join(
        f"SELECT {folded} AS folded, 'address_{state}_access' AS state, address, {pick}(block_number) AS block_number"
        f" {_RIGHT} GROUP BY address"
        for folded in ("true", "false")
        for state, pick in (("first", "min"), ("last", "max"))
    ),
)
_add(
    "retry_failed_chunks",
    _ledger(
        "reads_per_block",
        "reads_per_block",
        [n for n, _ in _READS],
        "cast(CASE WHEN lower = 0 THEN 2 ELSE 1 END AS integer) AS attempt,",
    ),
)
_add(
    "extract_failed_units",
    "SELECT 'INSERT INTO accounts -- retry' || chr(10) || 'SELECT ''' || transaction_hash ||"
    " ''' FROM file(''/data/' || cast(block_number * 10 + transaction_index AS varchar)"
    " || '.parquet'')' AS query,"
    " cast(block_number * 10 + transaction_index AS varchar) || '.parquet' AS file_name"
    " FROM c_transaction WHERE NOT success",
)
_add(
    "custom_table",
    "SELECT * FROM reads_per_block WHERE " + _BOUND.format(_last_blocks([n for n, _ in _READS])),
)
