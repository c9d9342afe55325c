"""DuckDB SQL that recomputes every registered query from the raw tables.

This is the independent check of the Spark plans: it follows the fixture
definitions of FIXTURES.md literally (line and order totals aggregated
separately, then joined; windows with ROW_NUMBER; scalar subqueries) and
shares no code with the Spark side beyond the constants.
"""

from __future__ import annotations

from collections.abc import Sequence

from ledgerlens.config import PREVIOUS_RUN_DATE, RUN_DATE
from ledgerlens.sources import fixtures as fx

DEC = "DECIMAL(18,2)"
TWO_RUNS = (PREVIOUS_RUN_DATE, RUN_DATE)


def letters(k: str) -> str:
    """Base 26, at least four letters, as many as the key needs."""
    parts = [f"chr(CAST(65 + ({k} // {26**p}) % 26 AS INTEGER))" for p in range(fx.LETTERS - 1, -1, -1)]
    lead = [
        f"CASE WHEN {k} >= {26**p} THEN {c} ELSE '' END" for p, c in zip(range(fx.LETTERS - 1, 3, -1), parts)
    ]
    return "(" + " || ".join(lead + parts[-4:]) + ")"


def dirty(k: str) -> str:
    t = letters(k)
    return (
        f"(CASE WHEN {k} % 3 = 0 THEN lower({t}) || '.jk' "
        f"WHEN {k} % 3 = 1 THEN {t} || '.JK' ELSE {t} END)"
    )


def norm(c: str) -> str:
    return f"trim(replace(upper({c}), '.JK', ''))"


def _m(c: str) -> str:
    return f"CAST({c} AS {DEC})"


def _dates(run_dates: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{d}'" for d in run_dates) + "]"


def _with_runs(table: str, run_dates: Sequence[str], date_col: str | None = None) -> str:
    """Rows of ``table`` once per run date (a generator, like explode),
    optionally only those dated on or before the run date."""
    inner = f"SELECT *, unnest({_dates(run_dates)}) AS run_date FROM {table}"
    if date_col is None:
        return f"({inner})"
    return f"({inner}) WHERE CAST({date_col} AS DATE) <= CAST(run_date AS DATE)"


def base_ctes(run_dates: Sequence[str] = (RUN_DATE,)) -> str:
    """CTEs ord_rd, cy_o, cy_l, fin (all periods, doubles), val, first_order, prof."""
    a = _m("l_extendedprice")
    return f"""ord_rd AS (SELECT * FROM {_with_runs("orders", run_dates, "o_orderdate")}),
cy_o AS (
  SELECT run_date, o_custkey AS k, year(o_orderdate) AS y,
         SUM({_m('o_totalprice')}) AS ta,
         SUM(CASE WHEN o_orderstatus = 'O' THEN {_m('o_totalprice')} ELSE 0 END) AS td
  FROM ord_rd
  GROUP BY run_date, o_custkey, year(o_orderdate)),
cy_l AS (
  SELECT run_date, o_custkey AS k, year(o_orderdate) AS y,
         SUM({a}) AS rev,
         SUM(CASE WHEN l_returnflag <> 'R' THEN {a} ELSE 0 END) AS gp,
         SUM(CASE WHEN l_returnflag = 'N' THEN {a} ELSE 0 END) AS n_amt,
         SUM(CASE WHEN l_returnflag = 'R' THEN {a} ELSE 0 END) AS r_amt,
         SUM(CASE WHEN l_linestatus = 'F' THEN {a} ELSE 0 END) AS ocf,
         SUM(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'R' THEN {a} ELSE 0 END) AS capex
  FROM lineitem JOIN ord_rd ON l_orderkey = o_orderkey
  GROUP BY run_date, o_custkey, year(o_orderdate)),
fin AS (
  SELECT o.run_date, o.k, CAST(o.y AS VARCHAR) AS period,
         CASE WHEN o.k % {fx.NULL_REVENUE_EVERY} = 0 THEN NULL ELSE CAST(l.rev AS DOUBLE) END AS revenue,
         CAST(l.gp AS DOUBLE) AS gross_profit,
         CAST(l.n_amt - l.r_amt AS DOUBLE) AS net_income,
         CAST(o.ta AS DOUBLE) AS total_assets,
         CAST(o.ta - o.td AS DOUBLE) AS total_equity,
         CAST(o.td AS DOUBLE) AS total_debt,
         CAST(l.ocf AS DOUBLE) AS operating_cash_flow,
         CAST(l.capex AS DOUBLE) AS capex,
         CAST(l.n_amt - l.r_amt AS DOUBLE) / {fx.EPS_PER_SHARE_DIVISOR} AS eps,
         CAST(l.rev AS DOUBLE) AS revenue_unforced
  FROM cy_o o LEFT JOIN cy_l l ON o.run_date = l.run_date AND o.k = l.k AND o.y = l.y),
val AS (
  SELECT f.run_date, f.k, f.period,
         f.revenue_unforced / NULLIF(f.net_income, 0) AS per,
         f.total_assets / NULLIF(f.total_equity, 0) AS pbv,
         c.c_acctbal AS price,
         f.total_debt / NULLIF(f.operating_cash_flow, 0) AS ev_ebitda
  FROM fin f LEFT JOIN customer c ON c.c_custkey = f.k),
first_order AS (
  SELECT run_date, o_custkey AS k, MIN(CAST(o_orderdate AS DATE)) AS first_date
  FROM ord_rd
  GROUP BY run_date, o_custkey),
prof AS (
  SELECT c.run_date, c.c_custkey AS k, c.c_name AS company_name, r.r_name AS sector,
         c.c_mktsegment AS sub_sector, c.c_acctbal * {float(fx.EPS_PER_SHARE_DIVISOR)} AS market_cap,
         strftime(fo.first_date, '%Y-%m-%d') AS listing_date
  FROM {_with_runs("customer", run_dates)} c
       LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
       LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
       LEFT JOIN first_order fo ON fo.run_date = c.run_date AND fo.k = c.c_custkey)"""


def _first_of(source: str, keys: str, order: str, cols: str) -> str:
    """One row per key, the first in the given order."""
    return (
        f"SELECT {cols} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY {order}) AS place "
        f"FROM {source}) WHERE place = 1"
    )


def silver_ctes(run_dates: Sequence[str] = (RUN_DATE,), dirty_input: bool = False) -> str:
    """Adds sfin, sprof, sval: clean tickers, one row per key. With
    ``dirty_input`` bronze has dirty tickers and repeated rows, and the
    silver rows are normalised and reduced to one per key."""
    if not dirty_input:
        return f"""{base_ctes(run_dates)},
sfin AS (
  SELECT run_date, {letters('k')} AS ticker, period, revenue, gross_profit, net_income,
         total_assets, total_equity, total_debt, operating_cash_flow, capex, eps
  FROM fin),
sprof AS (
  SELECT run_date, {letters('k')} AS ticker, company_name, sector, sub_sector, market_cap,
         listing_date
  FROM prof),
sval AS (
  SELECT run_date, {letters('k')} AS ticker, period, per, pbv, price, ev_ebitda
  FROM val WHERE per > 0 AND pbv > 0)"""
    again = f"k % {fx.DUPLICATE_EVERY} = 0"
    fin_order = ", ".join(f"{m} DESC NULLS LAST" for m in MEASURES)
    return f"""{base_ctes(run_dates)},
{bronze_fin_cte(dirty('k'), True)},
bprof AS (
  SELECT run_date, {dirty('k')} AS raw, company_name, sector, sub_sector, market_cap, listing_date FROM prof
  UNION ALL
  SELECT run_date, {dirty('k')} AS raw, company_name || ' II' AS company_name, sector, sub_sector, market_cap,
         listing_date FROM prof WHERE {again}),
bval AS (
  SELECT run_date, {dirty('k')} AS raw, period, per, pbv, price, ev_ebitda FROM val
  UNION ALL
  SELECT run_date, {dirty('k')} AS raw, period, per + 1 AS per, pbv, price, ev_ebitda FROM val WHERE {again}),
nfin AS (SELECT * EXCLUDE (ticker, k), {norm('ticker')} AS ticker FROM bfin),
nprof AS (SELECT * EXCLUDE (raw), {norm('raw')} AS ticker FROM bprof),
nval AS (SELECT * EXCLUDE (raw), {norm('raw')} AS ticker FROM bval WHERE per > 0 AND pbv > 0),
sfin AS ({_first_of('nfin', 'run_date, ticker, period', fin_order, 'run_date, ticker, period, ' + ', '.join(MEASURES))}),
sprof AS ({_first_of('nprof', 'run_date, ticker', 'company_name DESC NULLS LAST',
                     'run_date, ticker, company_name, sector, sub_sector, market_cap, listing_date')}),
sval AS ({_first_of('nval', 'run_date, ticker, period', 'per DESC, pbv DESC, price DESC NULLS LAST, ev_ebitda DESC NULLS LAST',
                    'run_date, ticker, period, per, pbv, price, ev_ebitda')})"""


def metric_ctes(run_dates: Sequence[str] = (RUN_DATE,), dirty_input: bool = False) -> str:
    """Adds growth, latest, cand (K1) and scored (K2) for every run date."""
    crit = " + ".join(
        f"COALESCE(CAST(({e}) AS INTEGER), 0)"
        for e in (
            "roe >= 0.15",
            "der <= 0.5",
            "fcf > 0",
            "eps_growth_yoy >= 0.1",
            "per <= 15",
            "pbv <= 1.5",
            "per * pbv <= 22.5",
        )
    )
    return f"""{silver_ctes(run_dates, dirty_input)},
growth AS (
  SELECT run_date, ticker, period, eps,
         LAG(eps, 1) OVER (PARTITION BY run_date, ticker ORDER BY period) AS p1,
         LAG(eps, 5) OVER (PARTITION BY run_date, ticker ORDER BY period) AS p5
  FROM sfin),
gm AS (
  SELECT run_date, ticker, period,
         (eps - p1) / NULLIF(ABS(p1), 0) AS eps_growth_yoy,
         round(CASE WHEN isnan(POWER(eps / NULLIF(ABS(p5), 0), CAST(0.2 AS DOUBLE)) - 1) THEN NULL
                    ELSE POWER(eps / NULLIF(ABS(p5), 0), CAST(0.2 AS DOUBLE)) - 1 END, 9) AS eps_cagr_5y
  FROM growth),
latest AS (SELECT run_date, ticker, MAX(period) AS period FROM sfin GROUP BY run_date, ticker),
ratio AS (
  SELECT run_date, ticker, period,
         net_income / NULLIF(total_equity, 0) AS roe, total_debt / NULLIF(total_equity, 0) AS der,
         operating_cash_flow - capex AS fcf, (operating_cash_flow - capex) / NULLIF(revenue, 0) AS fcf_margin
  FROM sfin),
newest AS (
  SELECT r.*, gm.eps_growth_yoy, gm.eps_cagr_5y
  FROM ratio r SEMI JOIN latest USING (run_date, ticker, period) LEFT JOIN gm USING (run_date, ticker, period)),
cand AS (
  SELECT n.run_date, n.ticker, sprof.company_name, sprof.sector, n.period, n.roe, n.der, n.fcf, n.fcf_margin,
         n.eps_growth_yoy, n.eps_cagr_5y, sval.per, sval.pbv, sval.per * sval.pbv AS graham_combined
  FROM newest n JOIN sprof USING (run_date, ticker) LEFT JOIN sval USING (run_date, ticker, period)),
scored AS (
  SELECT *, CAST({crit} AS INTEGER) AS criteria_passed,
         CASE WHEN {crit} = 7 THEN 'LOLOS' ELSE 'TIDAK' END AS status
  FROM cand),
fact AS (
  SELECT ticker, CAST(run_date AS DATE) AS run_date, period, company_name, sector, roe, der,
         fcf, fcf_margin, eps_growth_yoy, eps_cagr_5y, per, pbv, graham_combined,
         criteria_passed, status
  FROM scored)"""


def with_ctes(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


MEASURES = (
    "revenue", "gross_profit", "net_income", "total_assets", "total_equity", "total_debt",
    "operating_cash_flow", "capex", "eps",
)
FIN_COLS = "ticker, period, " + ", ".join(MEASURES) + ", run_date"


def bronze_fin_cte(ticker_sql: str, duplicates: bool) -> str:
    """bfin: bronze financial rows with the given ticker expression over k."""
    cols = ", ".join(MEASURES)
    plain = f"SELECT {ticker_sql} AS ticker, k, period, {cols}, run_date FROM fin"
    if not duplicates:
        return f"bfin AS ({plain})"
    again_cols = ", ".join("revenue + 1 AS revenue" if m == "revenue" else m for m in MEASURES)
    again = (
        f"SELECT {ticker_sql} AS ticker, k, period, {again_cols}, run_date FROM fin "
        f"WHERE k % {fx.DUPLICATE_EVERY} = 0"
    )
    return f"bfin AS ({plain} UNION ALL {again})"


def dedup_sql(source: str, ticker_expr: str) -> str:
    order = ", ".join(f"{m} DESC NULLS LAST" for m in MEASURES)
    return f"""SELECT {FIN_COLS} FROM (
  SELECT {ticker_expr} AS ticker, period, {", ".join(MEASURES)}, run_date,
         ROW_NUMBER() OVER (PARTITION BY run_date, {ticker_expr}, period ORDER BY {order}) AS rn
  FROM {source}) WHERE rn = 1"""


def suite_sql(suite, source: str, columns: Sequence[str]) -> str:
    """One SELECT per rule, UNION ALL, over the relation ``source``."""
    parts = []
    for i, r in enumerate(suite):
        kind = r["rule"]
        col = r.get("column")
        col_sql = f"'{col}'" if col else "CAST(NULL AS VARCHAR)"
        head = f"SELECT CAST({i} AS INTEGER) AS rule_id, '{kind}' AS rule, "
        if kind == "columns_present":
            missing = sum(1 for c in r["columns"] if c not in columns)
            parts.append(
                head + f"CAST(NULL AS VARCHAR) AS \"column\", CAST({len(r['columns'])} AS BIGINT) AS checked, "
                f"CAST({missing} AS BIGINT) AS failed, {str(missing == 0).lower()} AS success"
            )
            continue
        if kind == "unique_combination":
            keys = ", ".join(r["columns"])
            present = " OR ".join(f"{c} IS NOT NULL" for c in r["columns"])
            parts.append(
                head + f"'{','.join(r['columns'])}' AS \"column\", "
                "CAST(COALESCE(SUM(n), 0) AS BIGINT) AS checked, "
                "CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS failed, "
                "COUNT(*) FILTER (WHERE n > 1) = 0 AS success "
                f"FROM (SELECT {keys}, COUNT(*) AS n FROM {source} WHERE {present} GROUP BY {keys})"
            )
            continue
        if kind == "row_count_between":
            conds = []
            if r.get("min") is not None:
                conds.append(f"COUNT(*) >= {r['min']}")
            if r.get("max") is not None:
                conds.append(f"COUNT(*) <= {r['max']}")
            parts.append(
                head + f"{col_sql} AS \"column\", CAST(COUNT(*) AS BIGINT) AS checked, "
                f"CAST(0 AS BIGINT) AS failed, {' AND '.join(conds) or 'true'} AS success FROM {source}"
            )
            continue
        if kind == "not_null":
            checked, bad = "COUNT(*)", f"COUNT(*) FILTER (WHERE {col} IS NULL)"
        else:
            if kind == "matches_regex":
                ok = f"regexp_full_match({col}, '{r['regex']}')"
            elif kind == "in_set":
                ok = f"{col} IN ({', '.join(repr(v) for v in r['values'])})"
            else:
                bounds = []
                if r.get("min") is not None:
                    bounds.append(f"{col} >= {r['min']}")
                if r.get("max") is not None:
                    bounds.append(f"{col} <= {r['max']}")
                ok = " AND ".join(bounds)
            checked = f"COUNT({col})"
            bad = f"COUNT(*) FILTER (WHERE {col} IS NOT NULL AND NOT ({ok}))"
        if r.get("mostly") is None:
            success = f"{bad} = 0"
        else:
            success = (
                f"({checked} = 0 OR CAST({checked} - {bad} AS DOUBLE) / CAST({checked} AS DOUBLE) "
                f">= {float(r['mostly'])})"
            )
        parts.append(
            head + f"{col_sql} AS \"column\", CAST({checked} AS BIGINT) AS checked, "
            f"CAST({bad} AS BIGINT) AS failed, {success} AS success FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)
