"""Source tables of the dataset builders, derived from the benchmark tables.

Each text is plain SQL that Spark and DuckDB both run. In braces are the benchmark tables:
frames on the Spark side, names on the other.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import SparkSession

from folioflow.operators.scenario import CURVE_TENORS
from folioflow.queries.registry import table
from folioflow.sources.tables import SourceTables

_ITEMS = "{lineitem} JOIN {part} ON l_partkey = p_partkey"

_POSITIONS = f"""
SELECT 'S' || CAST(l_suppkey AS STRING) AS PRD_CODE,
       CASE l_returnflag WHEN 'A' THEN 'CNY' ELSE 'USD' END AS CUR_CODE,
       CAST(date_trunc('year', l_shipdate) AS DATE) AS BIZ_DATE,
       p_brand AS SECU_CODE, 'T' || p_brand AS SECU_TYPE_CODE, p_brand || '.X' AS SYMBOL,
       CASE WHEN p_brand <> 'Brand#7' THEN p_brand END AS SECU_NAME,
       l_extendedprice / l_quantity AS UNIT_COST, p_retailprice AS VAL_PRC, l_extendedprice AS POS_COST,
       CASE WHEN l_linenumber <> 3 THEN l_extendedprice * 0.9e0 END AS POS_MKV, l_quantity AS POS_QTY,
       CASE l_linestatus WHEN 'F' THEN 'H' ELSE 'T' END AS INVES_CLS_CODE,
       CASE CAST(substr(p_brand, 7) AS INT) % 4 WHEN 0 THEN 'BOND' WHEN 1 THEN 'STOCK'
            WHEN 2 THEN 'CASH_OTHER' ELSE 'FUND' END AS AST_BIG_CLS_CODE,
       'M' AS TX_MKT_CODE, CASE l_linenumber WHEN 7 THEN '1' ELSE '0' END AS DOWN_FLAG,
       l_tax AS RMN_COST, l_discount AS SHADOW_MKV
FROM {_ITEMS}"""

_MOVES = ", ".join(
    f"CASE WHEN p_size % {i + 2} <> 0 THEN p_size / {i + 1}.0e0 END AS {column}"
    for i, column in enumerate(CURVE_TENORS)
)

_STATEMENT_KEYS = """CASE WHEN %s THEN 'C' ELSE 'N' END || CAST(o_custkey AS STRING) AS PARTY_CODE,
       CASE o_orderstatus WHEN 'P' THEN '001' ELSE '003' END AS RPT_TYPE,
       CASE WHEN o_orderpriority = '5-LOW' THEN '003' ELSE '004' END AS RPT_TERM_TYPE,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS %s,
       CASE WHEN o_orderstatus = 'O' THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS END_DATE"""


def _statement(day: str, condition: str, **fields: str) -> str:
    """One of four statements; where the condition fails its company is one of its own."""
    measures = ", ".join(f"{how}(o_totalprice) AS {name}" for name, how in fields.items())
    return (
        f"SELECT {_STATEMENT_KEYS % (condition, day)}, {measures} FROM {{orders}} GROUP BY 1, 2, 3, 4, 5"
    )


def _panel(day: str, audited: bool = False) -> str:
    extra = ", CAST(l_shipdate AS DATE) AS create_time, CAST(l_shipdate AS DATE) AS update_time" if audited else ""
    return (
        f"SELECT 'P' || CAST(l_partkey AS STRING) AS instrument_code, {day} AS trade_date, "
        f"l_discount AS size, l_tax AS beta, l_quantity AS momentum{extra} FROM {{lineitem}}"
    )


_DAY = "CAST(l_shipdate AS DATE)"
_DAY_TEXT = "CAST(CAST(l_shipdate AS DATE) AS STRING)"

SOURCES = {
    "PERFORMANCE_BENCHMARKS": """
        SELECT 'B' || CAST(s_suppkey AS STRING) AS PERFORMANCE_BENCHMARK_CODE,
               s_name AS PERFORMANCE_BENCHMARK_NAME FROM {supplier}""",
    "INFO_FI_BASICINFO": """
        SELECT 'P' || CAST(p_partkey AS STRING) AS BOND_CODE, p_name AS CSNAME, p_brand AS BOND_SYMBOL,
               p_size * 30 AS BOND_TERM_DAY, p_size / 12.0e0 AS BOND_TERM_YEAR, 100 AS PAR_VALUE_ISS,
               p_type AS EXCH_CODE,
               CASE WHEN p_size % 3 = 0 THEN DATE '2009-01-01' + p_size END AS XPC_DUE_DATE,
               CASE WHEN p_size <> 50 THEN DATE '2010-01-01' + p_size END AS ACT_DUE_DATE,
               DATE '1994-06-01' + p_size AS ISS_START_DATE, lpad(CAST(p_size % 9 AS STRING), 3, '0') AS INT_RULE,
               DATE '1995-01-01' + p_size AS VALUE_DATE, p_size + 60.0e0 AS ISS_PRICE,
               'I' || CAST(p_size AS STRING) AS PARTY_CODE, p_size / 10.0e0 AS PAR_ANN_IR,
               CASE p_size % 4 WHEN 0 THEN '001' WHEN 1 THEN '002' WHEN 2 THEN '003' ELSE '999' END AS CPN_TYPE,
               CASE p_size % 3 WHEN 0 THEN '001' WHEN 1 THEN '002' ELSE '003' END AS IR_TYPE,
               CASE p_size % 3 WHEN 1 THEN 'SH001005' END AS FLT_BM_CODE,
               CASE p_size % 3 WHEN 1 THEN p_size / 8.0e0 END AS FLT_IR_SPRD,
               lpad(CAST(p_size % 13 AS STRING), 3, '0') AS PAY_FREQ, 0.5e0 AS ANN_IR_FLOOR,
               '00' || CAST(p_size % 4 AS STRING) AS INT_FML, '00' || CAST(p_size % 6 AS STRING) AS INT_ADJ_MODE,
               CASE WHEN p_size % 5 = 0 THEN DATE '2010-01-01' + p_size END AS DELIST_DATE,
               CASE WHEN p_size = 13 THEN '002' ELSE '001' END AS ISS_MODE
        FROM {part}""",
    "INFO_FI_BONDISSUE": """
        SELECT CASE WHEN p_size > 5 THEN 'P' ELSE 'N' END || CAST(p_partkey AS STRING) AS BOND_CODE,
               100.0e0 AS PAR_VALUE, p_size / 4.0e0 AS REF_FLD FROM {part}""",
    "INFO_FI_ADVANCE_REPAY": """
        SELECT 'P' || CAST(l_partkey AS STRING) AS BOND_CODE,
               CASE l_returnflag WHEN 'A' THEN '001' ELSE '002' END AS ADV_PAY_MODE,
               CAST(l_shipdate AS DATE) AS ADV_PAY_DATE,
               CASE WHEN l_linenumber <> 5 THEN l_quantity END AS ADV_PAY_RAT,
               l_extendedprice AS PAY_FIR_VALUE, l_extendedprice AS PAY_AFT_VALUE
        FROM {lineitem}""",
    "INFO_FI_RIT_EMB_XCS": """
        SELECT 'P' || CAST(l_partkey AS STRING) AS BOND_CODE,
               CASE l_linestatus WHEN 'F' THEN '001' ELSE '002' END AS RIT_TYPE,
               CAST(l_shipdate AS DATE) AS XCS_THRT_DATE, 100 + l_linenumber AS XCS_PRC,
               l_quantity * 100 AS HI_IR_ADJ, CASE WHEN l_tax > 0 THEN l_linenumber * 100 END AS LO_IR_ADJ,
               CASE l_returnflag WHEN 'R' THEN '001' ELSE '002' END AS DATA_TYPE
        FROM {lineitem}""",
    "INFO_FI_IR_DETAILED": """
        SELECT 'P' || CAST(o_custkey AS STRING) AS BOND_CODE, CAST(o_orderdate AS DATE) AS IR_START_DATE,
               CAST(o_orderdate AS DATE) + 90 AS IR_END_DATE, 1.5e0 AS BASE_IR,
               CASE WHEN o_orderstatus <> 'P' THEN (o_orderkey % 50 + 1) / 4.0e0 END AS IP_PAR_IR
        FROM {orders}""",
    "INFO_ZG_SEC_CLASSIFICATION": """
        SELECT CASE WHEN p_size > 2 THEN 'P' ELSE 'N' END || CAST(p_partkey AS STRING) AS SEC_CODE,
               p_brand AS CLS_CODE_1ST, p_type AS CLS_CODE_2ND,
               CASE WHEN p_size > 10 THEN p_brand END AS CLS_CODE_3RD,
               CASE WHEN p_size > 30 THEN p_type END AS CLS_CODE_4TH
        FROM {part}""",
    "PROD_FUNDS": "SELECT 'S' || CAST(s_suppkey AS STRING) AS FUND_CODE, s_name AS FUND_NAME FROM {supplier}",
    "INFO_FUND_BASICINFO": """
        SELECT 'C' || CAST(c_custkey AS STRING) AS FUND_CODE, c_name AS CSNAME,
               CASE WHEN c_acctbal < 0 THEN DATE '2001-01-01' + c_nationkey END AS DELIST_DATE
        FROM {customer}""",
    "INFO_IDX_BASICINFO": """
        SELECT 'X' || CAST(s_suppkey AS STRING) AS IDX_CODE, s_name AS CNAME,
               CAST(s_nationkey AS STRING) AS SYMBOL FROM {supplier}""",
    "INFO_STK_BASICINFO": """
        SELECT 'P' || CAST(p_partkey AS STRING) AS STK_CODE, p_name AS SYMBOL,
               'I' || CAST(p_size AS STRING) AS PARTY_CODE, p_size % 2 AS LIST_STATUS,
               CASE WHEN p_size > 5 THEN DATE '1994-01-01' + p_size END AS LIST_DATE,
               CASE WHEN p_size > 40 THEN DATE '2004-01-01' + p_size END AS DELIST_DATE,
               p_brand AS EXCH_CODE, '00' || CAST(p_size % 6 AS STRING) AS LIST_BRD, p_type AS SEC_TYPE
        FROM {part}""",
    "INDIC_DERI_BHMARK_INDU": f"""
        SELECT l_discount AS INDU_WT_RAT, {_DAY} AS BUSI_DATE, p_brand AS INDU_CODE_1ST, p_type AS INDU_NAME_1ST,
               l_tax AS INDU_RETURN_RAT, 'B' || CAST(l_suppkey AS STRING) AS BMARK_CODE, '075' AS INDU_SYS_CODE
        FROM {_ITEMS}""",
    "INFO_IDX_EODVALUE": """
        SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'SEC024342013' WHEN '2-HIGH' THEN 'SEC023059609'
                    WHEN '3-MEDIUM' THEN 'SEC023392778' ELSE 'OTHER' END AS IDX_CODE,
               CAST(o_orderdate AS DATE) AS TRD_DATE, o_totalprice AS CLS_PRC, o_custkey AS PCT_CHG
        FROM {orders}""",
    "INFO_FI_EODPRICE": f"""
        SELECT 'P' || CAST(l_partkey AS STRING) AS BOND_CODE,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS TRD_DATE, l_quantity AS VOL,
               l_extendedprice AS AMT_NET, l_discount AS HI_NET_PRC, l_tax AS LO_NET_PRC, l_linenumber AS TURN_RAT
        FROM {{lineitem}}""",
    "INFO_FI_VAL_CNBD": f"""
        SELECT 'P' || CAST(l_partkey AS STRING) AS BOND_CODE, {_DAY} AS TRD_DATE, l_linenumber AS RMN_YEAR,
               CASE WHEN l_discount > 0 THEN l_discount END AS YIELD, l_tax AS MODIF_DUR, l_quantity AS NET_PRC,
               l_extendedprice AS FULL_PRC, l_returnflag AS VAL_TYPE, l_linestatus AS IS_RCM, l_tax AS ACR_INT,
               CASE l_linenumber WHEN 7 THEN '002' ELSE '001' END AS DATA_SRC
        FROM {{lineitem}}""",
    "INFO_FI_VAL_CSI": f"""
        SELECT 'P' || CAST(l_partkey AS STRING) AS BOND_CODE, {_DAY} AS TRD_DATE,
               CASE WHEN l_discount > 0 THEN l_discount END AS YIELD, l_tax AS MODIF_DUR, l_quantity AS NET_PRC,
               l_extendedprice AS FULL_PRC, l_returnflag AS RCM_DIR
        FROM {{lineitem}}""",
    "INFO_FI_CASHFLOW": """
        SELECT 'P' || CAST(o_custkey AS STRING) AS BOND_CODE, CAST(o_orderdate AS DATE) AS CASH_DATE,
               o_totalprice AS PAY_INT, o_totalprice / 10.0e0 AS PRCP_CASH,
               100 - o_orderkey % 100 AS CASH_AMT_AFT, CASE o_orderstatus WHEN 'P' THEN 1 ELSE 0 END AS IS_ACT_CF
        FROM {orders}""",
    "INFO_FI_CFETS_YIELD_CURV": f"""
        SELECT {_DAY} AS TRD_DATE, CAST(l_linenumber AS DOUBLE) AS STD_TERM, l_discount AS YIELD,
               l_returnflag AS CURV_TYPE, p_type AS CURV_CNAME,
               CASE p_size % 3 WHEN 0 THEN 'CFE100372' WHEN 1 THEN 'CFE100552' ELSE 'CFE9' END AS CURV_CODE
        FROM {_ITEMS}""",
    "INFO_FUND_EODPRICE": f"""
        SELECT 'P' || CAST(l_partkey AS STRING) AS FUND_CODE,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS END_DATE, max(l_quantity) AS VOL,
               max(l_extendedprice) AS AMT, max(l_discount) AS HI_PRC, min(l_discount) AS LO_PRC,
               max(l_tax) AS CLS_PRC, max(l_quantity) AS CLS_PRC_ADJ, min(l_tax) AS TURN_RAT,
               min(l_quantity) AS PCT_CHG
        FROM {{lineitem}} GROUP BY 1, 2""",
    "INDIC_BASE_PORT_IDX": """
        SELECT 'C' || CAST(o_custkey AS STRING) AS PRD_CODE, CAST(o_orderdate AS DATE) AS BIZ_DATE,
               max(o_totalprice) AS UNIT_NAV,
               max(CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END) AS ADJ_UNIT_NAV
        FROM {orders} GROUP BY 1, 2""",
    "INDIC_DERI_PORT_PRFT_IDX": """
        SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN 'C' ELSE 'N' END || CAST(o_custkey AS STRING) AS PRD_CODE, CAST(o_orderdate AS DATE) AS BIZ_DATE,
               max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 10 END) AS DAY_UNIT_NAV_GROW_RATE
        FROM {orders} GROUP BY 1, 2""",
    "DM_PORT_ASSET": """
        SELECT 'C' || CAST(o_custkey AS STRING) AS PRODUCT_CODE, CAST(o_orderdate AS DATE) AS BUSI_DATE,
               max(o_totalprice) AS PE_NET_ASSET, max(o_orderkey) % 1000 AS PE_SHARES,
               min(o_totalprice) AS NET_CPTL_INFLOW_AMT, 1.5e0 AS LEVERAGE_RATE, 0.25e0 AS CASH_RATIO,
               0.5e0 AS INST_POSI_RIN, max(o_totalprice) AS ST_REALIZABLE_MKTVAL, min(o_totalprice) AS MKTV_FUND,
               CASE WHEN max(o_orderpriority) = '4-NOT SPECIFIED' THEN '1' ELSE '0' END AS DOWN_FLAG,
               CASE WHEN o_custkey % 3 > 0 THEN DATE '1996-01-01' + CAST(o_custkey % 1000 AS INT) END AS SET_UP_DATE
        FROM {orders} GROUP BY o_custkey, CAST(o_orderdate AS DATE)""",
    "INFO_FX_EXCHRATE": """
        SELECT CASE c_nationkey % 4 WHEN 0 THEN 'USDCNY' WHEN 1 THEN 'CNYUSD' WHEN 2 THEN 'HKDCNY'
                    ELSE 'CNYEUR' END AS FX_CODE, o_totalprice AS EXCH_PRC, CAST(o_orderdate AS DATE) AS END_DATE,
               CASE o_orderstatus WHEN 'P' THEN '002' ELSE '001' END AS PRC_TYPE,
               CASE o_orderpriority WHEN '5-LOW' THEN '002' ELSE '001' END AS PUB_ORG
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey""",
    "INFO_FI_CNBD_YIELD_CURV": f"""
        SELECT p_brand AS CURV_CODE, 'Curve ' || p_brand AS CURV_CNAME,
               CAST(date_trunc('year', l_shipdate) AS DATE) AS TRD_DATE, p_size / 4.0e0 AS STD_TERM,
               CAST(min(l_linenumber) AS DOUBLE) AS FWD_TERM_N,
               CASE WHEN max(l_discount) > 0.02e0 THEN max(l_discount) END AS YIELD
        FROM {_ITEMS} GROUP BY 1, 2, 3, 4""",
    "INFO_FI_BNK_DL_IR": """
        SELECT 'DL' || substr(o_orderpriority, 1, 1) AS IR_CODE, o_orderpriority AS CNAME,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS CHG_START_DATE,
               o_totalprice AS INTR_RAT
        FROM {orders}""",
    "INFO_FI_GLOBAL_IBOR": """
        SELECT 'SH00100' || CAST(user_id % 9 + 1 AS STRING) AS IR_CODE, event_type AS CNAME,
               CAST(ts AS DATE) AS TRD_DATE, value AS INTR_RAT FROM {events}""",
    "INFO_FI_MM_QUO": """
        SELECT CASE event_type WHEN 'view' THEN 'FR001001' ELSE 'FR9' END AS IR_CODE,
               CAST(ts AS DATE) AS TRD_DATE, value AS CLS_QUO_IR FROM {events}""",
    "INFO_FI_IR_BASICINFO": """
        SELECT p_brand AS IRCODE, CASE WHEN max(p_size) > 0 THEN '023' END AS IRTYPE, p_brand AS SYMBOL,
               'Rate ' || p_brand AS CNAME FROM {part} GROUP BY p_brand
        UNION ALL
        SELECT DISTINCT 'SH00100' || CAST(user_id % 9 + 1 AS STRING), '021', 'SHIBOR', 'Interbank'
        FROM {events}
        UNION ALL SELECT DISTINCT 'FR001001', '022', 'FR007', 'Fixing' FROM {events}""",
    "INFO_PARA_INFO": """
        SELECT DISTINCT '023' AS PARA_CODE, 'Bond curve' AS PARA_NAME, '031001' AS PARA_OBJ FROM {part}
        UNION ALL SELECT DISTINCT '021', 'Interbank', '031001' FROM {events}
        UNION ALL SELECT DISTINCT CASE WHEN event_type = 'error' THEN 'none' ELSE event_type END,
               'System ' || event_type, '020601' FROM {events}""",
    "INFO_PARTY_INDUSTRY": """
        SELECT 'I' || CAST(user_id AS STRING) AS PARTY_CODE, CAST(ts AS DATE) AS START_DATE,
               event_type AS INDU_SYS_CODE, 'S' || CAST(CAST(floor(value) AS INT) AS STRING) AS INDU_CODE_1ST,
               'Sector' AS INDU_NAME_1ST FROM {events}""",
    "INFO_FI_BONDRATING": """
        SELECT 'P' || CAST(user_id AS STRING) AS BOND_CODE, event_type AS CREDIT_RAT, CAST(ts AS DATE) AS ANC_DATE,
               lpad(CAST(event_id % 40 AS STRING), 3, '0') AS RAT_ORG FROM {events}""",
    "INFO_PARTY_RATING": """
        SELECT 'I' || CAST(user_id AS STRING) AS PARTY_CODE, event_type AS CREDIT_RAT, CAST(ts AS DATE) AS ANC_DATE,
               '002' AS RAT_ORG FROM {events}""",
    "CALENDARS": """
        SELECT DISTINCT o_orderpriority AS CALENDAR_ID,
               CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 0 END AS IS_DEFAULT_CALENDAR FROM {orders}""",
    "CALENDAR_DATES": """
        SELECT o_orderpriority AS CALENDAR_ID, CAST(o_orderdate AS DATE) AS CALENDAR_DATE,
               max(CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END) AS IS_TRADING_DAY
        FROM {orders} GROUP BY 1, 2""",
    "INFO_STK_EODPRICE": f"""
        SELECT 'P' || CAST(l_partkey AS STRING) AS STK_CODE, {_DAY} AS END_DATE, max(l_quantity) AS CLS_PRC_ADJ,
               CASE WHEN min(l_linenumber) = 1 THEN 0 ELSE max(l_linenumber) END AS PRE_CLS_PRC_ADJ,
               max(l_tax) AS PCT_CHG, max(l_extendedprice) AS AMT, max(l_quantity) AS VOL,
               max(l_discount) AS HI_PRC, min(l_discount) AS LO_PRC, min(l_tax) AS TURN_RAT,
               max(l_extendedprice) AS CLS_PRC, min(l_extendedprice) AS PRE_CLS_PRC
        FROM {{lineitem}} GROUP BY 1, 2""",
    "INFO_STK_VALUATION": f"""
        SELECT CASE WHEN l_returnflag <> 'R' THEN 'P' ELSE 'N' END || CAST(l_partkey AS STRING) AS STK_CODE,
               {_DAY} AS END_DATE, max(l_extendedprice) AS CV, min(l_extendedprice) AS MV, max(l_discount) AS DVD_YLD
        FROM {{lineitem}} GROUP BY 1, 2""",
    "INFO_PARTY_SHRSTRUC": """
        SELECT 'I' || CAST(o_custkey % 60 AS STRING) AS PARTY_CODE, CAST(o_orderdate AS DATE) AS ANC_DATE,
               CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS SHR_PS,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT) AS CHG_DATE,
               o_totalprice AS SHR_TTL, o_totalprice / 2.0e0 AS SHR_CRC
        FROM {orders}""",
    "INFO_IDX_WT_STK": f"""
        SELECT CASE p_size % 3 WHEN 0 THEN 'SEC024342013' WHEN 1 THEN 'SEC023059609' ELSE 'OTHER' END AS IDX_CODE,
               {_DAY} AS TRD_DATE, 'P' || CAST(l_partkey AS STRING) AS CPN_CODE, l_quantity AS WT
        FROM {_ITEMS}""",
    "OPTION_VOLATILITY_SURFACE": f"""
        SELECT p_brand AS ASSET_ID, {_DAY} AS DATE, l_returnflag AS VOLATILITY_TYPE, l_discount AS VOLATILITY,
               l_linenumber AS TENOR, l_tax AS FORWARD_TENOR, l_quantity AS STRIKE_PRICE, l_linestatus AS MONEYNESS,
               p_name AS ASSET_DESCRIPTION
        FROM {_ITEMS}""",
    "INFO_FI_YC_CNBD_SAMPLE": f"""
        SELECT p_brand AS CURV_CODE, 'Curve ' || p_brand AS CURV_CNAME, 'P' || CAST(l_partkey AS STRING) AS BOND_CODE,
               {_DAY} AS TRD_DATE
        FROM {_ITEMS}""",
    "PLATO_CFG_FACTOR": """
        SELECT 'F' || CAST(p_partkey AS STRING) AS ID, p_brand AS FACTOR_CODE, p_size % 3 AS FACTOR_TYPE
        FROM {part}""",
    "INDIC_BASE_PORT_POS_DTL": _POSITIONS,
    "INDIC_BASE_BOND_POS_DTL": _POSITIONS,
    "INDIC_BASE_REPO_POS_DTL": f"""
        SELECT CASE l_returnflag WHEN 'R' THEN 'S' ELSE 'N' END || CAST(l_suppkey AS STRING) AS PRD_CODE,
               CAST(date_trunc('year', l_shipdate) AS DATE) AS BIZ_DATE, p_brand AS SECU_CODE,
               l_linenumber AS REMN_TERM, l_extendedprice AS POS_COST
        FROM {_ITEMS}""",
    "INDIC_DOWN_RELATION": """
        SELECT 'S' || CAST(k AS STRING) AS PRODUCT_CODE, day AS VALUATION_DATE,
               'S' || CAST(child AS STRING) AS SECU_CODE, (k % 8 + 1) / 8.0e0 AS INVEST_RATE
        FROM (
          SELECT k, day, 2 * k + 1 AS child FROM (
            SELECT DISTINCT l_suppkey AS k, CAST(date_trunc('year', l_shipdate) AS DATE) AS day FROM {lineitem}) a
          UNION ALL
          SELECT k, day, 3 * k + 2 AS child FROM (
            SELECT DISTINCT l_suppkey AS k, CAST(date_trunc('year', l_shipdate) AS DATE) AS day FROM {lineitem}) b
        ) edges JOIN {supplier} ON child = s_suppkey""",
    "INDIC_BASE_TX_BOND": f"""
        SELECT 'S' || CAST(l_suppkey AS STRING) AS PRD_CODE, CAST(date_trunc('year', l_shipdate) AS DATE) AS TX_DATE,
               p_brand AS SECU_CODE, CASE l_returnflag WHEN 'A' THEN 'T02.02.000.001' WHEN 'R' THEN 'T02.02.000.002'
               ELSE 'T02.02.000.009' END AS TX_TYPE_CODE, l_quantity AS TRAN_QTY, l_extendedprice AS TRAN_NET_AMT,
               CASE WHEN l_linenumber <> 2 THEN l_extendedprice * 1.5e0 END AS ACTL_STL_AMT, l_tax AS INT_AMT
        FROM {_ITEMS}""",
    "INDIC_BASE_TX_STOCK": f"""
        SELECT 'S' || CAST(l_suppkey AS STRING) AS PRD_CODE, CAST(date_trunc('year', l_shipdate) AS DATE) AS CLR_DATE,
               p_brand AS SECU_CODE, CASE l_returnflag WHEN 'A' THEN 'T01.01.000.001' WHEN 'R' THEN 'T01.01.000.002'
               ELSE 'T01.01.000.009' END AS TX_TYPE_CODE, l_extendedprice AS TRAN_AMT, l_tax AS TX_FEE,
               l_quantity AS TRAN_QTY
        FROM {_ITEMS}""",
    "INFO_PARTY_FIN_BALANCE": _statement(
        "ANC_DATE", "o_orderpriority <> '1-URGENT'", LIAB_NONCUR="min", LIAB_TTL="max", AST_TTL="max", MNY_FUND="min",
        FIN_AST_TRAS="min", RCV_NOTE="min", OE_TTL="max", OE_MINOR="min",
    ),
    "INFO_PARTY_FIN_INCOME": _statement(
        "ANC_DATE", "o_orderpriority <> '2-HIGH'", INC_BIZ="max", NET_PFT="min", TTL_PFT="max"
    ),
    "INFO_PARTY_FIN_CASHFLOW": _statement(
        "ANC_DATE", "o_orderpriority <> '3-MEDIUM'", PAY_OBT_FIOLTA="max", RECP_DISP_FIOLTA="min", ICF="max",
        OCF="min", ICR_CASH_EQLT="max", CASH_EQLT_EOP="min",
    ),
    "INFO_PARTY_FIN_INDDRV": _statement(
        "ANC_DATE_LAT", "o_orderpriority <> '4-NOT SPECIFIED'", EPS_DIL_OP="max", ROA="min", GRO_PRO_MAR="max",
        GRO_MAR="max", ASS_RN="min", STM_IS="max", EXI_CUR="max", EXI_NON="min", ORPS="max", EBIT="min",
    ),
    "INFO_BARRA_EXPOSURE": _panel(_DAY),
    "INFO_BARRA_LEVEL2": _panel(_DAY),
    "INFO_BARRA_LEVEL2_MEAN": _panel(_DAY),
    "INFO_BARRA_LEVEL2_STD": _panel(_DAY),
    "INFO_BARRA_LEVEL3": _panel(_DAY),
    "INFO_BARRA_LEVEL3_MEAN": _panel(_DAY_TEXT),
    "INFO_BARRA_LEVEL3_STD": _panel(_DAY_TEXT),
    "INFO_BARRA_EXPOSURE_CNE5": _panel(_DAY, audited=True),
    "INFO_BARRA_FACTOR_RETURN_CNE5": _panel(_DAY, audited=True),
    "INFO_BARRA_FACTOR_RETURN_CNE6": _panel(_DAY),
    "PLATO_CS_PRD_ASSET_CLS_SYS": "SELECT DISTINCT p_brand AS CLS_TYPE, p_type AS CLS_CODE, p_type AS CLS_NAME FROM {part}",
    "PLATO_CS_PRD_ASSET_CLS_SYS_TYPE": """
        SELECT DISTINCT CASE WHEN p_size > 25 THEN p_brand ELSE 'none' END AS CLS_TYPE_CODE FROM {part}""",
    "PLATO_CS_PRD_ASSET_CLS_UD": """
        SELECT DISTINCT 'U' || CAST(c_nationkey AS STRING) AS CLS_TYPE_CODE, c_mktsegment AS CLS_CODE,
               c_mktsegment AS CLS_NAME FROM {customer}""",
    "PLATO_CS_PRD_ASSET_CLS_UD_TYPE": """
        SELECT DISTINCT CASE WHEN s_acctbal > 0 THEN 'U' ELSE 'N' END || CAST(s_nationkey AS STRING) AS CLS_TYPE_CODE
        FROM {supplier}""",
    "PLATO_CS_PRD_STR_CLS": """
        SELECT 'P' || CAST(p_partkey AS STRING) AS SECU_CODE, p_name AS SYMBOL, p_name AS SECU_NAME,
               p_type AS CLS_CODE, p_type AS CLS_NAME FROM {part}
        UNION ALL
        SELECT 'C' || CAST(c_custkey AS STRING), c_name, c_name, c_mktsegment, 'Own' FROM {customer}""",
    "PLATO_CFG_SCENE": """
        SELECT DISTINCT CASE WHEN p_size > 1 THEN p_brand ELSE 'none' END AS ID FROM {part}""",
    "PLATO_CFG_SCENE_FACTOR_SINGLE_REL": """
        SELECT 'R' || CAST(p_partkey AS STRING) AS ID, p_brand AS SCENE_ID,
               'F' || CAST(p_partkey AS STRING) AS FACTOR_ID, p_size % 3 AS FACTOR_TYPE, p_name AS FACTOR_NAME,
               p_type AS MODIFICATION_TYPE, p_retailprice AS MODIFICATION_VALUE,
               CAST(DATE '2020-01-01' + p_size AS STRING) AS TRADING_DATE FROM {part}""",
    "PLATO_CFG_SCENE_FACTOR_REL_CURVE": f"""
        SELECT 'R' || CAST(p_partkey AS STRING) AS SCENE_FACTOR_REL_ID, p_size % 2 + 1 AS TYPE, {_MOVES}
        FROM {{part}}""",
}

_NAMES = re.compile(r"\{(\w+)\}")


def source_sql(name: str) -> str:
    """The text with plain table names."""
    return _NAMES.sub(r"\1", SOURCES[name])


def with_sources(names: str, body: str) -> str:
    """A query over named source tables, each derived in a common table expression."""
    parts = ",\n".join(f"{name} AS ({source_sql(name)})" for name in names.split())
    return f"WITH RECURSIVE {parts}{',' if body.lstrip().startswith(',') else ''}\n{body.lstrip().lstrip(',')}"


def bound_sources(spark: SparkSession, sf_dir: str) -> SourceTables:
    def frame(text: str):
        frames = {t: table(spark, sf_dir, t) for t in set(_NAMES.findall(text))}
        return spark.sql(text, **frames)

    return SourceTables(spark, frames={n: partial(frame, text) for n, text in SOURCES.items()})
