"""The data-quality rules on the silver and gold tables (73 in total)."""

from __future__ import annotations

from ledgerline.operators.checks import Rule

# --- fixed values: test patterns and limits of the data contract ---
LOWER_UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
ANY_UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
STORE_GROUP = r"^[0-9A-F]{8}$"
RECEIPT_CHARS = r"^[A-Za-z0-9]+$"
REASONS = ("invalid_store_token", "invalid_transaction_id", "invalid_receipt_token",
           "invalid_transaction_time", "invalid_amount_format", "invalid_amount_negative",
           "invalid_user_role")


def _nn(model, *cols):
    return [Rule(model, "not_null", (c,)) for c in cols]


def _ge(model, col, lo):
    return Rule(model, "between", (col,), {"min_value": lo})


SILVER_RULES: list[Rule] = [
    # silver_stores
    *_nn("silver_stores", "store_token"),
    Rule("silver_stores", "unique", ("store_token",)),
    Rule("silver_stores", "regex", ("store_token",), {"regex": LOWER_UUID}),
    *_nn("silver_stores", "store_group"),
    Rule("silver_stores", "regex", ("store_group",), {"regex": STORE_GROUP}),
    Rule("silver_stores", "length_equal", ("store_group",), {"value": 8}),
    *_nn("silver_stores", "store_name"),
    Rule("silver_stores", "length_between", ("store_name",), {"min_value": 1, "max_value": 200}),
    *_nn("silver_stores", "batch_date", "source_file", "valid_from"),
    # silver_sales
    Rule("silver_sales", "compound_unique", ("store_token", "transaction_id")),
    *_nn("silver_sales", "store_token"),
    Rule("silver_sales", "relationship", ("store_token",),
         {"to": "silver_stores", "field": "store_token"}, severity="warn"),
    Rule("silver_sales", "regex", ("store_token",), {"regex": LOWER_UUID}),
    *_nn("silver_sales", "transaction_id"),
    Rule("silver_sales", "regex", ("transaction_id",), {"regex": ANY_UUID}),
    *_nn("silver_sales", "receipt_token"),
    Rule("silver_sales", "length_between", ("receipt_token",), {"min_value": 5, "max_value": 30}),
    Rule("silver_sales", "regex", ("receipt_token",), {"regex": RECEIPT_CHARS}),
    *_nn("silver_sales", "transaction_time", "amount"),
    _ge("silver_sales", "amount", 0),
    *_nn("silver_sales", "user_role"),
    Rule("silver_sales", "length_between", ("user_role",), {"min_value": 1, "max_value": 30}),
    *_nn("silver_sales", "batch_date"),
    # silver_sales_rejected
    *_nn("silver_sales_rejected", "rejection_reason"),
    Rule("silver_sales_rejected", "in_set", ("rejection_reason",), {"values": REASONS}),
    *_nn("silver_sales_rejected", "source_file", "batch_date"),
    # silver_sales_audit_by_batch
    *_nn("silver_sales_audit_by_batch", "batch_date"),
    Rule("silver_sales_audit_by_batch", "unique", ("batch_date",)),
    *_nn("silver_sales_audit_by_batch", "total_raw_transactions"),
    _ge("silver_sales_audit_by_batch", "total_raw_transactions", 0),
    *_nn("silver_sales_audit_by_batch", "valid_transactions"),
    _ge("silver_sales_audit_by_batch", "valid_transactions", 0),
    *_nn("silver_sales_audit_by_batch", "invalid_transactions"),
    _ge("silver_sales_audit_by_batch", "invalid_transactions", 0),
    *_nn("silver_sales_audit_by_batch", "processing_date"),
]

O1, O2, O3 = "rpt_transactions_by_batch", "rpt_sales_by_transaction_date", \
    "rpt_top_5_stores_by_date"
GOLD_RULES: list[Rule] = [
    Rule(O1, "row_count", (), {"min_value": 0, "max_value": 40}),
    *_nn(O1, "snapshot_date", "batch_date"),
    Rule(O1, "unique", ("batch_date",)),
    *_nn(O1, "total_raw_transactions"), _ge(O1, "total_raw_transactions", 0),
    *_nn(O1, "valid_transactions"), _ge(O1, "valid_transactions", 0),
    *_nn(O1, "invalid_transactions"), _ge(O1, "invalid_transactions", 0),
    *_nn(O1, "processing_date"),
    Rule(O2, "row_count", (), {"min_value": 0, "max_value": 40}),
    *_nn(O2, "snapshot_date", "transaction_date"),
    Rule(O2, "unique", ("transaction_date",)),
    *_nn(O2, "stores_with_transactions"), _ge(O2, "stores_with_transactions", 1),
    *_nn(O2, "total_sales_amount"), _ge(O2, "total_sales_amount", 0),
    *_nn(O2, "total_sales_average"), _ge(O2, "total_sales_average", 0),
    *_nn(O2, "month_accumulated_sales"), _ge(O2, "month_accumulated_sales", 0),
    Rule(O2, "regex", ("top_store_token",),
         {"regex": LOWER_UUID, "row_condition": "top_store_token is not null"}),
    Rule(O3, "row_count", (), {"min_value": 0, "max_value": 50}),
    Rule(O3, "compound_unique", ("transaction_date", "top_rank_id")),
    *_nn(O3, "snapshot_date", "transaction_date", "top_rank_id"),
    Rule(O3, "in_set", ("top_rank_id",), {"values": (1, 2, 3, 4, 5)}),
    *_nn(O3, "store_total_sales"), _ge(O3, "store_total_sales", 0),
    *_nn(O3, "store_token"),
    Rule(O3, "regex", ("store_token",), {"regex": LOWER_UUID}),
]


def oracle_sql_for(rules: list[Rule], relation: dict[str, str]) -> str:
    """DuckDB SQL giving the same result rows as ``run_checks`` (one SELECT
    per rule, UNION ALL). ``relation`` maps a model to a CTE/view name."""
    sel = []
    for r in rules:
        t = relation[r.model]
        head = (f"'{r.model}' AS model, '{r.kind}' AS check_name, "
                f"'{r.column_name}' AS column_name, '{r.severity}' AS severity")
        c = r.columns[0] if r.columns else None
        p = r.params
        if r.kind == "not_null":
            body = f"count(*) FILTER (WHERE {c} IS NULL)"
            sel.append(f"SELECT {head}, cast({body} AS BIGINT) AS failures FROM {t}")
            continue
        if r.kind == "row_count":
            cond = []
            if p.get("min_value") is not None:
                cond.append(f"count(*) < {p['min_value']}")
            if p.get("max_value") is not None:
                cond.append(f"count(*) > {p['max_value']}")
            body = f"CASE WHEN {' OR '.join(cond)} THEN 1 ELSE 0 END"
            sel.append(f"SELECT {head}, cast({body} AS BIGINT) AS failures FROM {t}")
            continue
        if r.kind in ("unique", "compound_unique"):
            cols = ", ".join(r.columns)
            keep = " OR ".join(f"{x} IS NOT NULL" for x in r.columns)
            sel.append(f"SELECT {head}, cast(count(*) AS BIGINT) AS failures FROM "
                       f"(SELECT {cols} FROM {t} WHERE {keep} GROUP BY {cols} "
                       f"HAVING count(*) > 1)")
            continue
        if r.kind == "relationship":
            pt = relation[p["to"]]
            sel.append(f"SELECT {head}, cast(count(*) AS BIGINT) AS failures FROM {t} "
                       f"WHERE {c} IS NOT NULL AND {c} NOT IN "
                       f"(SELECT {p['field']} FROM {pt} WHERE {p['field']} IS NOT NULL)")
            continue
        if r.kind == "regex":
            fail = f"NOT regexp_matches({c}, '{p['regex']}')"
        elif r.kind == "length_equal":
            fail = f"length({c}) <> {p['value']}"
        elif r.kind in ("length_between", "between"):
            v = f"length({c})" if r.kind == "length_between" else c
            parts = []
            if p.get("min_value") is not None:
                parts.append(f"{v} < {p['min_value']}")
            if p.get("max_value") is not None:
                parts.append(f"{v} > {p['max_value']}")
            fail = " OR ".join(parts)
        elif r.kind == "in_set":
            vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in p["values"])
            fail = f"{c} NOT IN ({vals})"
        else:
            raise ValueError(r.kind)
        where = f"{c} IS NOT NULL AND ({fail})"
        if p.get("row_condition"):
            where += f" AND ({p['row_condition']})"
        sel.append(f"SELECT {head}, cast(count(*) FILTER (WHERE {where}) AS BIGINT) "
                   f"AS failures FROM {t}")
    return "\nUNION ALL\n".join(sel)
