"""Every dataset builder on source tables derived from the benchmark tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from folioflow.operators import classes
from folioflow.operators.scenario import CURVE_TENORS
from folioflow.plans import BuildContext, build_dataset
from folioflow.queries.bindings import bound_sources, with_sources
from folioflow.queries.registry import FINE_NUDGE, NUDGE, day, query, rounded, table
from folioflow.schemas import DATASETS, PANEL_TABLES


#: What a dataset's query does with its rows at the end, for other queries of the same rows.
FINISH: dict[str, Callable[[DataFrame], DataFrame]] = {}
DATES: dict[str, list[str]] = {}


def label_of(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def dataset_query(name: str, sources: str, body: str, finish=None) -> None:
    """Register the builder of a dataset as `dataset_<name>` with its SQL twin."""
    label = label_of(name)

    def run(spark, sf_dir):
        rows = build_dataset(name, BuildContext(bound_sources(spark, sf_dir)))
        return finish(rows) if finish else rows

    schema = DATASETS[name].schema
    dates = [f.name for f in schema if isinstance(f.dataType, T.DateType)] if schema else ["trade_date"]
    FINISH[name] = finish or (lambda rows: rows)
    DATES[name] = dates
    query(with_sources(sources, body), f"dataset_{label}", " ".join(dates))(run)


def rounding(digits: int, *columns: str, nudge: float = 0.0):
    return lambda df: rounded(df, digits, *columns, nudge=nudge)


def D(*columns: str) -> str:
    """Columns cast to double: `SOURCE name` pairs."""
    return ", ".join("CAST({} AS DOUBLE) AS {}".format(*c.split()) for c in columns)


dataset_query("BenchMarkInfo", "PERFORMANCE_BENCHMARKS", """
SELECT PERFORMANCE_BENCHMARK_CODE AS instrument_code, PERFORMANCE_BENCHMARK_NAME AS instrument_name,
       'BENCH_MARK' AS instrument_type FROM PERFORMANCE_BENCHMARKS""")

dataset_query("StockIndexInfo", "INFO_IDX_BASICINFO", """
SELECT IDX_CODE AS instrument_code, CNAME AS instrument_name, SYMBOL AS symbol,
       'STOCK_INDEX' AS instrument_type FROM INFO_IDX_BASICINFO""")

dataset_query("FundInfo", "PROD_FUNDS INFO_FUND_BASICINFO", """
SELECT FUND_CODE AS instrument_code, FUND_NAME AS instrument_name, CAST(NULL AS DATE) AS delist_date,
       'FUND' AS instrument_type FROM PROD_FUNDS
UNION ALL
SELECT FUND_CODE, CSNAME, DELIST_DATE, 'FUND' FROM INFO_FUND_BASICINFO""")

dataset_query("StockInfo", "INFO_STK_BASICINFO", """
SELECT STK_CODE AS instrument_code, SYMBOL AS symbol, PARTY_CODE AS issuer_code,
       CAST(LIST_STATUS AS STRING) AS list_status, coalesce(strftime(LIST_DATE, '%Y%m%d'), '') AS list_date,
       coalesce(strftime(DELIST_DATE, '%Y%m%d'), '') AS delist_date, EXCH_CODE AS exchange_code,
       'STOCK' AS instrument_type,
       CASE LIST_BRD WHEN '001' THEN 'SEC026261761' WHEN '003' THEN 'SEC024022199'
                     WHEN '004' THEN 'SEC045336986' ELSE '' END AS index,
       CASE LIST_BRD WHEN '001' THEN '上证综指' WHEN '003' THEN '创业板指数'
                     WHEN '004' THEN '上证科创板50成份指数' ELSE '' END AS index_name,
       SEC_TYPE AS sec_type
FROM INFO_STK_BASICINFO""")


def _json(key: str, value: str) -> str:
    return f"""'{{' || string_agg('"' || strftime({key}, '%Y%m%d') || '":' || CAST({value} AS STRING), ','
            ORDER BY {key}) || '}}'"""


def _flat_bond(df):
    """Arrays as text, so that both engines can compare them."""
    arrays = ["interest_start_date", "interest_end_date"]
    numbers = ["interest_period_interest_rate", "float_rate_records"]
    return df.withColumns(
        {
            **{c: F.array_join(c, ",") for c in arrays},
            **{c: F.array_join(F.col(c).cast("array<string>"), ",") for c in numbers},
        }
    )


dataset_query(
    "BondInfo",
    "INFO_FI_BASICINFO INFO_FI_BONDISSUE INFO_FI_ADVANCE_REPAY INFO_FI_RIT_EMB_XCS INFO_FI_IR_DETAILED "
    "INFO_ZG_SEC_CLASSIFICATION",
    f""",
repay AS (
  SELECT BOND_CODE, ADV_PAY_DATE AS d, max(ADV_PAY_RAT) / 100.0e0 AS r FROM INFO_FI_ADVANCE_REPAY
  WHERE ADV_PAY_MODE = '001' AND ADV_PAY_RAT IS NOT NULL GROUP BY 1, 2
), repay_map AS (
  SELECT BOND_CODE, {_json("d", "r")} AS notional_reduce_map FROM repay GROUP BY 1
), rights AS (
  SELECT BOND_CODE, XCS_THRT_DATE AS d, RIT_TYPE, CAST(XCS_PRC AS DOUBLE) AS price,
         HI_IR_ADJ / 10000.0e0 AS high, coalesce(LO_IR_ADJ / 10000.0e0, 100000.0e0) AS low
  FROM INFO_FI_RIT_EMB_XCS WHERE DATA_TYPE = '002'
), prices AS (SELECT BOND_CODE, d, RIT_TYPE, max(price) AS price FROM rights GROUP BY 1, 2, 3),
calls AS (SELECT BOND_CODE, {_json("d", "price")} AS call_option_map FROM prices WHERE RIT_TYPE = '002' GROUP BY 1),
puts AS (SELECT BOND_CODE, {_json("d", "price")} AS put_option_map FROM prices WHERE RIT_TYPE = '001' GROUP BY 1),
adjusts AS (
  SELECT BOND_CODE, d, high, low,
         row_number() OVER (PARTITION BY BOND_CODE, d ORDER BY RIT_TYPE DESC, high DESC, low DESC) AS n
  FROM rights
), adjust_maps AS (
  SELECT BOND_CODE, {_json("d", "high")} AS high_interest_rate_adj, {_json("d", "low")} AS low_interest_rate_adj
  FROM adjusts WHERE n = 1 GROUP BY 1
), periods AS (
  SELECT BOND_CODE, IR_START_DATE AS s, IR_END_DATE AS e, coalesce(IP_PAR_IR / 100.0e0, 0.0e0) AS rate
  FROM INFO_FI_IR_DETAILED
), period_lists AS (
  SELECT BOND_CODE, min(s) AS first_start,
         string_agg(strftime(s, '%Y%m%d'), ',' ORDER BY s, e, rate) AS interest_start_date,
         string_agg(strftime(e, '%Y%m%d'), ',' ORDER BY s, e, rate) AS interest_end_date,
         string_agg(CAST(rate AS STRING), ',' ORDER BY s, e, rate) AS interest_period_interest_rate
  FROM periods GROUP BY 1
), steps AS (SELECT BOND_CODE, s, max(rate) AS rate FROM periods GROUP BY 1, 2),
step_maps AS (SELECT BOND_CODE, {_json("s", "rate")} AS coupon_change_map FROM steps GROUP BY 1),
base AS (
  SELECT b.*, i.PAR_VALUE, i.REF_FLD,
         CAST(coalesce(VALUE_DATE - first_start, 0) AS DOUBLE) AS adjust_num_for_lastest,
         CAST(CASE INT_ADJ_MODE WHEN '001' THEN 1 WHEN '002' THEN 4 WHEN '003' THEN 2 WHEN '005' THEN 3 ELSE 2 END
              AS BIGINT) AS frn_adjust_rate,
         CAST(CASE INT_FML WHEN '001' THEN 2 WHEN '002' THEN 1 ELSE 9 END AS BIGINT) AS calc_way,
         CASE CPN_TYPE WHEN '001' THEN 'ZeroCouponBond' WHEN '002' THEN 'DiscountBond' WHEN '003' THEN 'CouponBond'
              WHEN '999' THEN 'ELSE' END AS coupon_type
  FROM INFO_FI_BASICINFO b LEFT JOIN INFO_FI_BONDISSUE i USING (BOND_CODE)
  LEFT JOIN period_lists USING (BOND_CODE)
  WHERE ISS_MODE = '001' AND ACT_DUE_DATE IS NOT NULL
)
SELECT BOND_CODE AS instrument_code, CSNAME AS instrument_name, BOND_SYMBOL || '.' || EXCH_CODE AS symbol,
       CAST(BOND_TERM_DAY AS DOUBLE) AS bond_term_day, BOND_TERM_YEAR AS bond_term_year,
       CAST(PAR_VALUE_ISS AS DOUBLE) AS par_value_iss, EXCH_CODE AS market,
       XPC_DUE_DATE AS estimated_maturity_date, ACT_DUE_DATE AS maturity_date, ISS_START_DATE AS iss_start_date,
       CASE INT_RULE WHEN '001' THEN 'A/365' WHEN '002' THEN 'Act/Act' WHEN '003' THEN 'A/360'
            WHEN '004' THEN '30/360' WHEN '006' THEN 'A/366' WHEN '007' THEN 'A/365F'
            WHEN '008' THEN 'AVG/ACT' END AS day_count,
       VALUE_DATE AS start_date, ISS_PRICE AS issue_price, PARTY_CODE AS issuer_code,
       PAR_ANN_IR / 100.0e0 AS par_rate_issue, coupon_type,
       CASE IR_TYPE WHEN '002' THEN 'FloatRateBond' ELSE 'FixedRateBond' END AS interest_rate_type,
       FLT_BM_CODE AS benchmark_code, FLT_IR_SPRD / 100.0e0 AS spread,
       CASE WHEN coupon_type = 'ZeroCouponBond' THEN 'Once' ELSE
         CASE PAY_FREQ WHEN '001' THEN 'Annual' WHEN '002' THEN 'Semiannual' WHEN '003' THEN 'Once'
              WHEN '004' THEN 'Quarterly' WHEN '005' THEN 'Monthly' WHEN '008' THEN 'EveryFourthMonth'
              WHEN '011' THEN 'Bimonthly' WHEN '000' THEN NULL WHEN '012' THEN NULL
              ELSE 'OtherFrequency' END END AS pay_frequency,
       ANN_IR_FLOOR AS ann_ir_floor, calc_way, frn_adjust_rate, PAR_VALUE AS par_value,
       REF_FLD / 100.0e0 AS reference_rate_issue, 'BOND' AS instrument_type, CAST(4 AS BIGINT) AS coupon_accuracy,
       CAST(1 AS BIGINT) AS is_create_new, notional_reduce_map, call_option_map, put_option_map,
       high_interest_rate_adj, low_interest_rate_adj, adjust_num_for_lastest, interest_start_date,
       interest_end_date, interest_period_interest_rate, coupon_change_map, DELIST_DATE AS delist_date,
       '4.0,1.0,' || CAST(adjust_num_for_lastest AS STRING) || ',' || CAST(frn_adjust_rate AS STRING) || '.0,'
         || CAST(calc_way AS STRING) || '.0' AS float_rate_records,
       CASE WHEN SEC_CODE IS NOT NULL THEN coalesce(CLS_CODE_1ST, '其他') END AS CLS_CODE_1ST,
       CASE WHEN SEC_CODE IS NOT NULL THEN coalesce(CLS_CODE_2ND, '其他') END AS CLS_CODE_2ND,
       CASE WHEN SEC_CODE IS NOT NULL THEN coalesce(CLS_CODE_3RD, '其他') END AS CLS_CODE_3RD,
       CASE WHEN SEC_CODE IS NOT NULL THEN coalesce(CLS_CODE_4TH, '其他') END AS CLS_CODE_4TH
FROM base LEFT JOIN repay_map USING (BOND_CODE) LEFT JOIN calls USING (BOND_CODE)
LEFT JOIN puts USING (BOND_CODE) LEFT JOIN adjust_maps USING (BOND_CODE) LEFT JOIN period_lists USING (BOND_CODE)
LEFT JOIN step_maps USING (BOND_CODE) LEFT JOIN INFO_ZG_SEC_CLASSIFICATION ON BOND_CODE = SEC_CODE""",
    _flat_bond,
)

dataset_query("BenchmarkDailyIndustryReturn", "INDIC_DERI_BHMARK_INDU", """
SELECT INDU_WT_RAT AS weight, BUSI_DATE AS trade_date, INDU_CODE_1ST AS instrument_code,
       INDU_NAME_1ST AS instrument_name, INDU_RETURN_RAT AS return_rate, BMARK_CODE AS benchmark_code,
       INDU_SYS_CODE AS industry_sys_code FROM INDIC_DERI_BHMARK_INDU""")

dataset_query("BenchmarkDailyQuote", "INFO_IDX_EODVALUE", """
SELECT TRD_DATE AS trade_date, CLS_PRC AS close, PCT_CHG / 100.0e0 AS return_percentage,
       IDX_CODE AS instrument_code
FROM INFO_IDX_EODVALUE
WHERE IDX_CODE IN ('SEC024342013', 'SEC023059609', 'SEC023392778', 'SEC024022199', 'SEC045336986')""")

dataset_query("BondDailyQuote", "INFO_FI_EODPRICE", """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY BOND_CODE, TRD_DATE
                               ORDER BY VOL, AMT_NET, HI_NET_PRC, LO_NET_PRC, TURN_RAT) AS n
  FROM INFO_FI_EODPRICE
)
SELECT BOND_CODE AS instrument_code, TRD_DATE AS trade_date, VOL AS volume, AMT_NET AS trade_amount,
       HI_NET_PRC AS high, LO_NET_PRC AS low, CAST(TURN_RAT AS DOUBLE) AS turnover
FROM ranked WHERE n = 1""")

dataset_query("BondValCNBD", "INFO_FI_VAL_CNBD INFO_FI_CASHFLOW", """,
flows AS (SELECT * FROM INFO_FI_CASHFLOW WHERE IS_ACT_CF = 0),
rest AS (SELECT BOND_CODE, CASH_DATE, max(CASH_AMT_AFT) AS amount FROM flows GROUP BY 1, 2),
paid AS (
  SELECT v.*, coalesce(f.PAY_INT, 0) AS interest, coalesce(f.PRCP_CASH, 0) AS principal
  FROM INFO_FI_VAL_CNBD v LEFT JOIN flows f ON v.BOND_CODE = f.BOND_CODE AND v.TRD_DATE = f.CASH_DATE
  WHERE v.YIELD IS NOT NULL AND v.DATA_SRC = '001'
)
SELECT p.BOND_CODE AS instrument_code, TRD_DATE AS trade_date, CAST(RMN_YEAR AS DOUBLE) AS remn_term,
       YIELD / 100.0e0 AS ytm, MODIF_DUR AS duration, NET_PRC AS valuation_net_price,
       FULL_PRC AS valuation_full_price, interest, principal, VAL_TYPE AS val_type, IS_RCM AS is_rcm,
       CAST(coalesce(amount, 100) AS DOUBLE) AS cash_amt_aft, ACR_INT AS acr_int
FROM paid p ASOF LEFT JOIN rest r ON p.BOND_CODE = r.BOND_CODE AND p.TRD_DATE >= r.CASH_DATE""")

dataset_query("BondValCSI", "INFO_FI_VAL_CSI INFO_FI_CASHFLOW", """
SELECT a.BOND_CODE AS instrument_code, TRD_DATE AS trade_date, YIELD / 100.0e0 AS ytm, MODIF_DUR AS duration,
       NET_PRC AS valuation_net_price, FULL_PRC AS valuation_full_price, PAY_INT AS interest,
       PRCP_CASH AS principal, RCM_DIR AS rcm_dir
FROM (SELECT * FROM INFO_FI_VAL_CSI WHERE YIELD IS NOT NULL) a
LEFT JOIN (SELECT * FROM INFO_FI_CASHFLOW WHERE IS_ACT_CF = 0) b
  ON a.BOND_CODE = b.BOND_CODE AND a.TRD_DATE = b.CASH_DATE""")

dataset_query("FiYieldCurve", "INFO_FI_CFETS_YIELD_CURV", """
SELECT TRD_DATE AS trade_date, STD_TERM AS std_term, YIELD AS ytm, CURV_TYPE AS curve_type,
       CURV_CNAME AS curve_type_name, CURV_CODE AS curve_code FROM INFO_FI_CFETS_YIELD_CURV""")

FUND_QUOTES = """
starts AS (SELECT PRODUCT_CODE, min(SET_UP_DATE) AS s FROM DM_PORT_ASSET GROUP BY 1),
assets AS (
  SELECT a.*, CASE WHEN BUSI_DATE = s THEN PE_NET_ASSET ELSE PE_SHARES END AS shares,
         coalesce(BUSI_DATE = s, false) AS is_start
  FROM DM_PORT_ASSET a LEFT JOIN starts USING (PRODUCT_CODE) WHERE DOWN_FLAG = '0'
), valued AS (
  SELECT *, CASE WHEN is_start THEN 1 ELSE (PE_NET_ASSET - NET_CPTL_INFLOW_AMT)
            / nullif(lag(shares) OVER (PARTITION BY PRODUCT_CODE ORDER BY BUSI_DATE), 0) END AS nav
  FROM assets
), computed AS (
  SELECT PRODUCT_CODE, BUSI_DATE, nav, CASE WHEN NOT is_start THEN
         nav / nullif(lag(nav) OVER (PARTITION BY PRODUCT_CODE ORDER BY BUSI_DATE), 0) - 1 END AS change
  FROM valued
), quotes AS (
  SELECT FUND_CODE AS instrument_code, END_DATE AS trade_date, VOL AS volume, AMT AS trade_amount, HI_PRC AS high,
         LO_PRC AS low, CLS_PRC AS close, TURN_RAT AS turnover, PCT_CHG / 100.0e0 AS return_percentage,
         CLS_PRC_ADJ AS close_adjusted FROM INFO_FUND_EODPRICE
  UNION ALL BY NAME
  SELECT i.PRD_CODE AS instrument_code, i.BIZ_DATE AS trade_date, UNIT_NAV AS close,
         CASE WHEN ADJ_UNIT_NAV IS NULL THEN coalesce(CAST(DAY_UNIT_NAV_GROW_RATE AS DOUBLE), change)
              ELSE DAY_UNIT_NAV_GROW_RATE END AS return_percentage,
         coalesce(ADJ_UNIT_NAV, nav) AS close_adjusted
  FROM INDIC_BASE_PORT_IDX i JOIN INDIC_DERI_PORT_PRFT_IDX USING (PRD_CODE, BIZ_DATE)
  LEFT JOIN computed ON PRD_CODE = PRODUCT_CODE AND BIZ_DATE = BUSI_DATE
), lagged AS (
  SELECT *, lag(close_adjusted) OVER (PARTITION BY instrument_code ORDER BY trade_date) AS before FROM quotes
), fund_quotes AS (
  SELECT *, CASE WHEN close_adjusted <> 0 AND before <> 0 THEN close_adjusted / before - 1 END AS adjusted
  FROM lagged
)"""
FUND_SOURCES = "INFO_FUND_EODPRICE INDIC_BASE_PORT_IDX INDIC_DERI_PORT_PRFT_IDX DM_PORT_ASSET"

dataset_query(
    "FundDailyQuote",
    FUND_SOURCES,
    f""",{FUND_QUOTES}
SELECT instrument_code, trade_date, volume, trade_amount, high, low, close, turnover,
       round(return_percentage + {FINE_NUDGE:.12f}, 6) AS return_percentage,
       round(close_adjusted + {NUDGE}, 4) AS close_adjusted,
       round(adjusted + {FINE_NUDGE:.12f}, 6) AS return_percentage_adjusted,
       round(CASE WHEN adjusted > -1 THEN ln(1 + adjusted) END + {FINE_NUDGE:.12f}, 6)
         AS return_percentage_adjusted_log
FROM fund_quotes""",
    lambda df: rounded(
        rounded(df, 4, "close_adjusted", nudge=NUDGE),
        6, "return_percentage", "return_percentage_adjusted", "return_percentage_adjusted_log", nudge=FINE_NUDGE,
    ),
)

dataset_query("FxExchRate", "INFO_FX_EXCHRATE", """
SELECT FX_CODE AS fx_code, EXCH_PRC AS exch_rate, END_DATE AS trade_date, PRC_TYPE AS prc_type,
       PUB_ORG AS pub_org FROM INFO_FX_EXCHRATE WHERE PRC_TYPE = '001' AND PUB_ORG = '001'""")

CURVE_POINTS = """
codes AS (
  SELECT CURV_CODE AS code FROM INFO_FI_YC_CNBD_SAMPLE
  UNION SELECT FACTOR_CODE FROM PLATO_CFG_FACTOR WHERE FACTOR_TYPE = 2
), points AS (SELECT * FROM INFO_FI_CNBD_YIELD_CURV WHERE CURV_CODE IN (SELECT code FROM codes))"""

dataset_query(
    "IndexRate",
    "INFO_FI_YC_CNBD_SAMPLE PLATO_CFG_FACTOR INFO_FI_CNBD_YIELD_CURV INFO_FI_BNK_DL_IR INFO_FI_GLOBAL_IBOR "
    "INFO_FI_IR_BASICINFO INFO_PARA_INFO",
    f""",{CURVE_POINTS},
rates AS (
  SELECT CURV_CODE AS index, CURV_CNAME AS index_name, TRD_DATE AS trade_date,
         CASE WHEN STD_TERM = floor(STD_TERM) THEN CAST(CAST(STD_TERM AS BIGINT) AS STRING)
              ELSE CAST(STD_TERM AS STRING) END || 'Y' AS tenor,
         CAST(CAST(FWD_TERM_N AS BIGINT) AS STRING) || 'Y' AS tenor2, YIELD / 100.0e0 AS rate
  FROM points WHERE YIELD IS NOT NULL AND STD_TERM IN (0, 0.25e0, 0.5e0, 0.75e0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)
  UNION ALL BY NAME
  SELECT IR_CODE AS index, CNAME AS index_name, CHG_START_DATE AS trade_date, INTR_RAT / 100.0e0 AS rate
  FROM INFO_FI_BNK_DL_IR WHERE CHG_START_DATE IS NOT NULL
  UNION ALL BY NAME
  SELECT IR_CODE AS index, CNAME AS index_name, TRD_DATE AS trade_date, INTR_RAT / 100.0e0 AS rate,
         CASE IR_CODE WHEN 'SH001001' THEN '0.0027Y' WHEN 'SH001002' THEN '0.0194Y' WHEN 'SH001003' THEN '0.0389Y'
              WHEN 'SH001004' THEN '0.0833Y' WHEN 'SH001005' THEN '0.25Y' WHEN 'SH001006' THEN '0.5Y'
              WHEN 'SH001007' THEN '0.75Y' WHEN 'SH001008' THEN '1Y' END AS tenor
  FROM INFO_FI_GLOBAL_IBOR
)
SELECT index, index_name, trade_date, tenor, tenor2, rate, 'cny' AS currency, 'DEPOSIT' AS instrument_type,
       IRTYPE AS curve_type, PARA_NAME AS curve_type_name
FROM rates LEFT JOIN INFO_FI_IR_BASICINFO ON index = IRCODE
LEFT JOIN (SELECT * FROM INFO_PARA_INFO WHERE PARA_OBJ = '031001') ON IRTYPE = PARA_CODE""",
)

dataset_query("IndustryClassificationMktData", "INFO_PARTY_INDUSTRY INFO_PARA_INFO", """
SELECT PARTY_CODE AS issuer_code, START_DATE AS trade_date, INDU_SYS_CODE AS industry_code,
       INDU_CODE_1ST AS sector_code, INDU_NAME_1ST AS sector_name, PARA_NAME AS industry_name
FROM INFO_PARTY_INDUSTRY JOIN INFO_PARA_INFO ON INDU_SYS_CODE = PARA_CODE AND PARA_OBJ = '020601'""")

dataset_query("InstrumentRating", "INFO_FI_BONDRATING", """
SELECT BOND_CODE AS instrument_code, CREDIT_RAT AS rating, ANC_DATE AS trade_date, RAT_ORG AS rating_organization
FROM INFO_FI_BONDRATING WHERE RAT_ORG IN ('002', '003', '004', '005', '006', '034', '013', '014', '019')""")

dataset_query("IssuerRating", "INFO_PARTY_RATING", """
SELECT PARTY_CODE AS issuer_code, CREDIT_RAT AS rating, ANC_DATE AS trade_date, RAT_ORG AS rating_organization
FROM INFO_PARTY_RATING""")

dataset_query("Calendar", "CALENDARS CALENDAR_DATES", """
SELECT 'CAL0004' AS scope, CALENDAR_ID AS calendar_id, CALENDAR_DATE AS calendar_date
FROM CALENDAR_DATES JOIN CALENDARS USING (CALENDAR_ID) WHERE IS_TRADING_DAY = 1 AND IS_DEFAULT_CALENDAR = 1
UNION ALL
SELECT 'ALL', CALENDAR_ID, CALENDAR_DATE FROM CALENDAR_DATES WHERE IS_TRADING_DAY = 1""")

STOCK_QUOTES = """
latest AS (
  SELECT *, row_number() OVER (PARTITION BY PARTY_CODE, ANC_DATE
    ORDER BY CHG_DATE DESC NULLS LAST, SHR_PS DESC NULLS LAST, SHR_TTL DESC NULLS LAST) AS n
  FROM INFO_PARTY_SHRSTRUC
), changes AS (SELECT * FROM latest WHERE n = 1),
preferred AS (SELECT PARTY_CODE, ANC_DATE, SHR_PS FROM changes WHERE SHR_PS IS NOT NULL),
firsts AS (
  SELECT PARTY_CODE, min_by(SHR_PS, ANC_DATE) FILTER (SHR_PS IS NOT NULL) AS ps, min_by(CHG_DATE, ANC_DATE) AS cd,
         min_by(SHR_TTL, ANC_DATE) AS ttl, min_by(SHR_CRC, ANC_DATE) AS crc
  FROM changes GROUP BY 1
), prices AS (
  SELECT p.*, v.CV, v.MV, v.DVD_YLD, b.PARTY_CODE
  FROM INFO_STK_EODPRICE p JOIN INFO_STK_VALUATION v USING (STK_CODE, END_DATE)
  LEFT JOIN INFO_STK_BASICINFO b USING (STK_CODE)
  WHERE STK_CODE IN (SELECT CPN_CODE FROM INFO_IDX_WT_STK WHERE IDX_CODE = 'SEC024342013')
), shared AS (
  SELECT p.*, c.CHG_DATE, c.SHR_TTL, c.SHR_CRC, s.SHR_PS
  FROM prices p
  ASOF LEFT JOIN changes c ON p.PARTY_CODE = c.PARTY_CODE AND p.END_DATE >= c.ANC_DATE
  ASOF LEFT JOIN preferred s ON p.PARTY_CODE = s.PARTY_CODE AND p.END_DATE >= s.ANC_DATE
), stock_quotes AS (
  SELECT s.PARTY_CODE AS issuer_code, CLS_PRC_ADJ AS close_adjusted,
         CAST(PRE_CLS_PRC_ADJ AS DOUBLE) AS prev_close_adjusted, PCT_CHG / 100.0e0 AS return_percentage,
         END_DATE AS trade_date, STK_CODE AS instrument_code, AMT AS trade_amount, VOL AS volume, HI_PRC AS high,
         LO_PRC AS low, TURN_RAT AS turnover, CLS_PRC AS close, PRE_CLS_PRC AS prev_close,
         CV AS negotiable_market_capitalization, MV AS market_capitalization, DVD_YLD / 100.0e0 AS dividend_yield,
         coalesce(SHR_PS, ps) AS preferred_stock, coalesce(CHG_DATE, cd) AS due_date,
         coalesce(SHR_TTL, ttl) AS shares_outstanding, coalesce(SHR_CRC, crc) AS circulating_shares,
         CASE WHEN CLS_PRC_ADJ <> 0 AND PRE_CLS_PRC_ADJ <> 0 THEN CLS_PRC_ADJ / PRE_CLS_PRC_ADJ - 1 END AS adjusted
  FROM shared s LEFT JOIN firsts f ON s.PARTY_CODE = f.PARTY_CODE
)"""
STOCK_SOURCES = "INFO_STK_EODPRICE INFO_STK_VALUATION INFO_STK_BASICINFO INFO_PARTY_SHRSTRUC INFO_IDX_WT_STK"

dataset_query(
    "StockDailyQuote",
    STOCK_SOURCES,
    f""",{STOCK_QUOTES}
SELECT * EXCLUDE (adjusted), round(adjusted, 8) AS return_percentage_adjusted,
       round(CASE WHEN adjusted > -1 THEN ln(1 + adjusted) END, 8) AS return_percentage_adjusted_log
FROM stock_quotes""",
    rounding(8, "return_percentage_adjusted", "return_percentage_adjusted_log"),
)

dataset_query(
    "TimeSeries",
    f"{STOCK_SOURCES} {FUND_SOURCES} INFO_FI_YC_CNBD_SAMPLE PLATO_CFG_FACTOR INFO_FI_CNBD_YIELD_CURV "
    "INFO_FI_CFETS_YIELD_CURV INFO_FI_BNK_DL_IR INFO_FI_GLOBAL_IBOR INFO_FI_MM_QUO INFO_FI_IR_BASICINFO",
    f""",{STOCK_QUOTES},{FUND_QUOTES},{CURVE_POINTS},
knots AS (
  SELECT CURV_CODE AS index, TRD_DATE AS trade_date, STD_TERM AS tenor, max(YIELD) / 100.0e0 AS rate
  FROM points JOIN INFO_FI_IR_BASICINFO ON CURV_CODE = IRCODE AND IRTYPE = '023'
  WHERE YIELD IS NOT NULL GROUP BY 1, 2, 3
), tops AS (SELECT index, max(tenor) AS top FROM knots GROUP BY 1),
grid AS (
  SELECT DISTINCT k.index, k.trade_date, round(i / 365.0e0, 2) AS tenor
  FROM (SELECT DISTINCT index, trade_date FROM knots) k JOIN tops t ON k.index = t.index,
  LATERAL (SELECT unnest(generate_series(0, CAST(floor(t.top * 365) AS BIGINT))) AS i)
), placed AS (
  SELECT g.*, l.tenor AS x0, l.rate AS y0, r.tenor AS x1, r.rate AS y1
  FROM grid g
  ASOF LEFT JOIN knots l ON g.index = l.index AND g.trade_date = l.trade_date AND g.tenor >= l.tenor
  ASOF LEFT JOIN knots r ON g.index = r.index AND g.trade_date = r.trade_date AND g.tenor <= r.tenor
), series AS (
  SELECT instrument_code AS index, trade_date, '' AS tenor, adjusted AS rate,
         'ADJUSTED_RETURN' AS time_series_type FROM stock_quotes
  UNION ALL BY NAME SELECT instrument_code AS index, trade_date, '' AS tenor, close_adjusted AS rate,
         'ADJUSTED_PRICE' AS time_series_type FROM stock_quotes
  UNION ALL BY NAME SELECT instrument_code AS index, trade_date, '' AS tenor, adjusted AS rate,
         'ADJUSTED_RETURN' AS time_series_type FROM fund_quotes
  UNION ALL BY NAME SELECT instrument_code AS index, trade_date, '' AS tenor, close_adjusted AS rate,
         'ADJUSTED_PRICE' AS time_series_type FROM fund_quotes
  UNION ALL BY NAME SELECT index, trade_date, CAST(tenor AS STRING) || 'Y' AS tenor,
         CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL OR x1 = x0 THEN y0
              ELSE (y1 - y0) / (x1 - x0) * (tenor - x0) + y0 END AS rate,
         'YIELD_CURVE' AS time_series_type FROM placed
  UNION ALL BY NAME SELECT CURV_CODE AS index, TRD_DATE AS trade_date,
         CAST(CAST(STD_TERM AS BIGINT) AS STRING) || 'Y' AS tenor, YIELD / 100.0e0 AS rate, 'cny' AS currency,
         'DEPOSIT' AS instrument_type, 'IRS_CURVE' AS time_series_type,
         CASE CURV_CODE WHEN 'CFE100372' THEN 'SHIB3M' ELSE 'FR007' END AS symbol
         FROM INFO_FI_CFETS_YIELD_CURV WHERE CURV_CODE <> 'CFE9'
  UNION ALL BY NAME SELECT IR_CODE AS index, CNAME AS index_name, CHG_START_DATE AS trade_date,
         INTR_RAT / 100.0e0 AS rate, 'cny' AS currency, 'DEPOSIT' AS instrument_type, 'DEPOSIT' AS time_series_type
         FROM INFO_FI_BNK_DL_IR WHERE CHG_START_DATE IS NOT NULL
  UNION ALL BY NAME SELECT IR_CODE AS index, b.CNAME AS index_name, TRD_DATE AS trade_date, SYMBOL AS symbol,
         INTR_RAT / 100.0e0 AS rate, 'cny' AS currency, 'DEPOSIT' AS instrument_type,
         'DEPOSIT' AS time_series_type,
         CASE IR_CODE WHEN 'SH001001' THEN '1D' WHEN 'SH001002' THEN '1W' WHEN 'SH001003' THEN '2W'
              WHEN 'SH001004' THEN '1M' WHEN 'SH001005' THEN '3M' WHEN 'SH001006' THEN '6M'
              WHEN 'SH001007' THEN '9M' WHEN 'SH001008' THEN '1Y' END AS tenor
         FROM INFO_FI_GLOBAL_IBOR a JOIN INFO_FI_IR_BASICINFO b ON IR_CODE = IRCODE
  UNION ALL BY NAME SELECT IR_CODE AS index, CNAME AS index_name, TRD_DATE AS trade_date, SYMBOL AS symbol,
         CLS_QUO_IR / 100.0e0 AS rate, 'cny' AS currency, 'DEPOSIT' AS instrument_type,
         'DEPOSIT' AS time_series_type, '7D' AS tenor
         FROM INFO_FI_MM_QUO JOIN INFO_FI_IR_BASICINFO ON IR_CODE = IRCODE WHERE IR_CODE = 'FR001001'
)
SELECT index, index_name, symbol, trade_date, tenor, round(rate + {FINE_NUDGE:.12f}, 6) AS rate, currency,
       instrument_type, time_series_type
FROM series
WHERE rate IS NOT NULL OR time_series_type NOT IN ('ADJUSTED_RETURN', 'ADJUSTED_PRICE')""",
    rounding(6, "rate", nudge=FINE_NUDGE),
)

dataset_query("VolatilitySurface", "OPTION_VOLATILITY_SURFACE", """
SELECT ASSET_ID AS instrument_code, DATE AS trade_date, VOLATILITY_TYPE AS volatility_type,
       VOLATILITY AS volatility, CAST(TENOR AS DOUBLE) AS tenor, FORWARD_TENOR AS forward_tenor,
       STRIKE_PRICE AS strike_price, MONEYNESS AS moneyness, ASSET_DESCRIPTION AS instrument_name
FROM OPTION_VOLATILITY_SURFACE""")

dataset_query("YieldCurveCNBDSample", "INFO_FI_YC_CNBD_SAMPLE", """
SELECT CURV_CODE AS index, CURV_CNAME AS index_name, BOND_CODE AS instrument_code, TRD_DATE AS trade_date
FROM INFO_FI_YC_CNBD_SAMPLE""")


def _consolidated(source: str, extra: str, condition: str = "true") -> str:
    return f"""
grouped AS (
  SELECT PRD_CODE AS book_id, CUR_CODE AS currency, BIZ_DATE AS trade_date, SECU_CODE AS instrument_code,
         SECU_TYPE_CODE AS secu_type_code, SYMBOL AS symbol, coalesce(SECU_NAME, '') AS instrument_name,
         max(UNIT_COST) AS unit_cost, max(VAL_PRC) AS valuation_price,
         CASE WHEN sum(POS_QTY) = 0 THEN 0 ELSE sum(POS_QTY * POS_COST) / sum(POS_QTY) END AS cost,
         coalesce(sum(POS_MKV), 0) AS market_value, sum(POS_QTY) AS quantity, INVES_CLS_CODE = 'H' AS held_to_maturity,
         TX_MKT_CODE AS market, {extra}
  FROM {source} WHERE {condition} GROUP BY ALL
)"""


dataset_query(
    "BondPosition",
    "INDIC_BASE_BOND_POS_DTL",
    f""",{_consolidated("INDIC_BASE_BOND_POS_DTL", "RMN_COST AS rmn_cost, SHADOW_MKV AS shadow_market_value")}
SELECT * EXCLUDE (unit_cost, cost, market_value, quantity), round(unit_cost + {NUDGE}, 4) AS unit_cost,
       round(cost + {NUDGE}, 4) AS cost, round(market_value + {NUDGE}, 4) AS market_value,
       round(quantity, 4) AS quantity
FROM grouped""",
    lambda df: rounded(rounded(df, 4, "unit_cost", "cost", "market_value", nudge=NUDGE), 4, "quantity"),
)

dataset_query("CombAsset", "DM_PORT_ASSET", f"""
SELECT PRODUCT_CODE AS instrument_code, BUSI_DATE AS trade_date,
       {D("PE_NET_ASSET close", "PE_SHARES quantity", "NET_CPTL_INFLOW_AMT net_cptl_inflow_amt",
          "LEVERAGE_RATE leverage_rate", "CASH_RATIO cash_ratio", "INST_POSI_RIN inst_posi_rin",
          "ST_REALIZABLE_MKTVAL realizable_market_value", "MKTV_FUND market_value")}, DOWN_FLAG AS down_flag
FROM DM_PORT_ASSET""")

_TERMS = """
terms AS (
  SELECT PRD_CODE AS book_id, BIZ_DATE AS trade_date, SECU_CODE AS instrument_code,
         sum(REMN_TERM * POS_COST) / sum(POS_COST) AS remn_term
  FROM INDIC_BASE_REPO_POS_DTL GROUP BY 1, 2, 3
)"""
_TYPE = """CASE AST_BIG_CLS_CODE WHEN 'CASH_OTHER' THEN 'CASH' ELSE AST_BIG_CLS_CODE END AS instrument_type"""
POSITION_SOURCES = "INDIC_BASE_PORT_POS_DTL INDIC_BASE_REPO_POS_DTL"

dataset_query(
    "CombPosition",
    POSITION_SOURCES,
    f""",{_consolidated("INDIC_BASE_PORT_POS_DTL", _TYPE, "DOWN_FLAG = '0'")},{_TERMS}
SELECT book_id, currency, trade_date, instrument_code, secu_type_code, symbol, instrument_name,
       round(unit_cost + {NUDGE}, 4) AS unit_cost, valuation_price, round(cost + {NUDGE}, 4) AS cost,
       round(market_value + {NUDGE}, 4) AS market_value, quantity,
       lag(quantity) OVER w AS prev_quantity, round(lag(market_value) OVER w + {NUDGE}, 4) AS prev_market_value,
       round(lag(cost) OVER w + {NUDGE}, 4) AS prev_cost, held_to_maturity, instrument_type, market,
       round(coalesce(remn_term, 0) + {NUDGE}, 4) AS remn_term
FROM grouped LEFT JOIN terms USING (book_id, trade_date, instrument_code)
WINDOW w AS (PARTITION BY book_id, instrument_code ORDER BY trade_date, currency, market, held_to_maturity)""",
    rounding(
        4, "unit_cost", "cost", "market_value", "prev_market_value", "prev_cost", "remn_term", nudge=NUDGE
    ),
)

_PENETRATED = f"""
paths AS (
  SELECT PRODUCT_CODE AS root, VALUATION_DATE AS day, SECU_CODE AS child, INVEST_RATE AS rate
  FROM INDIC_DOWN_RELATION
  UNION ALL
  SELECT p.root, p.day, e.SECU_CODE, p.rate * e.INVEST_RATE
  FROM paths p JOIN INDIC_DOWN_RELATION e ON p.child = e.PRODUCT_CODE AND p.day = e.VALUATION_DATE
), pairs AS (SELECT root, day, child, sum(rate) AS rate FROM paths GROUP BY 1, 2, 3),
{_consolidated("INDIC_BASE_PORT_POS_DTL", _TYPE, "DOWN_FLAG = '0'").strip()},
held AS (
  SELECT root AS book_id, currency, trade_date, instrument_code, valuation_price, rate,
         secu_type_code, symbol, instrument_name, instrument_type, market,
         market_value * rate AS market_value, quantity * rate AS quantity, cost * rate AS cost
  FROM grouped JOIN pairs ON trade_date = day AND book_id = child
), scaled AS (
  SELECT book_id, currency, trade_date, instrument_code, valuation_price, rate, sum(market_value) AS market_value,
         sum(quantity) AS quantity, sum(cost) AS cost FROM held GROUP BY 1, 2, 3, 4, 5, 6
), lagged AS (
  SELECT *, lag(quantity) OVER w AS prev_quantity, lag(market_value) OVER w AS prev_market_value,
         lag(cost) OVER w AS prev_cost
  FROM scaled WINDOW w AS (PARTITION BY book_id, instrument_code ORDER BY trade_date, currency, valuation_price, rate)
), attributes AS (
  SELECT instrument_code, min(secu_type_code) AS secu_type_code, min(symbol) AS symbol,
         min(instrument_name) AS instrument_name, min(instrument_type) AS instrument_type, min(market) AS market
  FROM held GROUP BY 1
)"""

dataset_query(
    "CombPositionPenetrate",
    f"{POSITION_SOURCES} INDIC_DOWN_RELATION",
    f""",{_PENETRATED},{_TERMS}
SELECT l.book_id, currency, l.trade_date, l.instrument_code, secu_type_code, symbol, instrument_name, instrument_type,
       round(market_value + {NUDGE}, 3) AS market_value, round(quantity + {NUDGE}, 4) AS quantity,
       round(cost / nullif(quantity, 0) + {NUDGE}, 3) AS unit_cost, round(cost + {NUDGE}, 3) AS cost,
       round(prev_quantity + {NUDGE}, 4) AS prev_quantity,
       round(prev_market_value + {NUDGE}, 3) AS prev_market_value, round(prev_cost + {NUDGE}, 3) AS prev_cost,
       valuation_price, market, round(coalesce(remn_term, 0) + {NUDGE}, 4) AS remn_term
FROM lagged l LEFT JOIN terms t
  ON l.book_id = t.book_id AND l.trade_date = t.trade_date AND l.instrument_code = t.instrument_code
LEFT JOIN attributes a ON l.instrument_code = a.instrument_code""",
    lambda df: rounded(
        rounded(df.drop("held_to_maturity"), 4, "quantity", "prev_quantity", "remn_term", nudge=NUDGE),
        3, "market_value", "unit_cost", "cost", "prev_market_value", "prev_cost", nudge=NUDGE,
    ),
)

dataset_query("DownRelationPortfolio", "INDIC_DOWN_RELATION", """
SELECT PRODUCT_CODE AS book_id, VALUATION_DATE AS trade_date, SECU_CODE AS children_book_id,
       INVEST_RATE AS invest_rate FROM INDIC_DOWN_RELATION""")

dataset_query("StockIndexPortfolio", "INFO_IDX_WT_STK", """
SELECT IDX_CODE AS book_id, TRD_DATE AS trade_date, CPN_CODE AS instrument_code, WT / 100.0e0 AS quantity
FROM INFO_IDX_WT_STK
WHERE IDX_CODE IN ('SEC024342013', 'SEC023059609', 'SEC023392778', 'SEC024022199', 'SEC045336986')""")


def _signed(column: str) -> str:
    return f"""round(coalesce(sum(CASE TX_TYPE_CODE WHEN 'T02.02.000.001' THEN {column}
         WHEN 'T02.02.000.002' THEN -{column} END), 0) + {NUDGE}, 4)"""


dataset_query(
    "BondTradeInfo",
    "INDIC_BASE_TX_BOND",
    f"""
SELECT PRD_CODE AS book_id, TX_DATE AS trade_date, SECU_CODE AS instrument_code, {_signed("TRAN_QTY")} AS notional,
       {_signed("TRAN_NET_AMT")} AS trade_amount, {_signed("ACTL_STL_AMT")} AS settlement_amount,
       round(sum(INT_AMT) + {NUDGE}, 4) AS acr_int
FROM INDIC_BASE_TX_BOND GROUP BY 1, 2, 3""",
    rounding(4, "notional", "trade_amount", "settlement_amount", "acr_int", nudge=NUDGE),
)

dataset_query(
    "StockTradeInfo",
    "INDIC_BASE_TX_STOCK",
    f"""
SELECT PRD_CODE AS book_id, CLR_DATE AS trade_date, SECU_CODE AS instrument_code,
       round(sum(TX_FEE) + {NUDGE}, 4) AS trading_fee,
       round(sum(CASE TX_TYPE_CODE WHEN 'T01.01.000.001' THEN TRAN_QTY ELSE -TRAN_QTY END) + {NUDGE}, 4) AS notional,
       round(coalesce(sum(TRAN_AMT) FILTER (TX_TYPE_CODE = 'T01.01.000.001'), 0) + {NUDGE}, 4) AS buy_amount,
       round(coalesce(sum(TRAN_AMT) FILTER (TX_TYPE_CODE = 'T01.01.000.002'), 0) + {NUDGE}, 4) AS sell_amount
FROM INDIC_BASE_TX_STOCK WHERE TX_TYPE_CODE IN ('T01.01.000.001', 'T01.01.000.002') GROUP BY 1, 2, 3""",
    rounding(4, "trading_fee", "notional", "buy_amount", "sell_amount", nudge=NUDGE),
)

dataset_query(
    "BondTradePenetrateInfo",
    f"{POSITION_SOURCES} INDIC_DOWN_RELATION",
    f""",{_PENETRATED}
SELECT book_id, trade_date, instrument_code, round(coalesce(quantity - prev_quantity, 0) + {NUDGE}, 4) AS notional,
       round(coalesce(cost - prev_cost, 0) + {NUDGE}, 3) AS trade_amount,
       round(coalesce(cost - prev_cost, 0) + {NUDGE}, 3) AS settlement_amount, CAST(0 AS DOUBLE) AS trading_fee
FROM lagged JOIN attributes USING (instrument_code) WHERE instrument_type = 'BOND'""",
    lambda df: rounded(
        rounded(df, 4, "notional", nudge=NUDGE), 3, "trade_amount", "settlement_amount", nudge=NUDGE
    ),
)

dataset_query(
    "StockTradePenetrateInfo",
    f"{POSITION_SOURCES} INDIC_DOWN_RELATION",
    f""",{_PENETRATED}
SELECT book_id, trade_date, instrument_code, round(quantity - prev_quantity + {NUDGE}, 4) AS notional,
       round(CASE WHEN cost - prev_cost < 0 THEN 0 ELSE cost - prev_cost END + {NUDGE}, 3) AS buy_amount,
       round(CASE WHEN cost - prev_cost < 0 THEN cost - prev_cost ELSE 0 END + {NUDGE}, 3) AS sell_amount,
       CAST(0 AS DOUBLE) AS trading_fee
FROM lagged JOIN attributes USING (instrument_code) WHERE instrument_type = 'STOCK'""",
    lambda df: rounded(
        rounded(df, 4, "notional", nudge=NUDGE), 3, "buy_amount", "sell_amount", nudge=NUDGE
    ),
)

_KEYS = ("PARTY_CODE", "RPT_TYPE", "RPT_TERM_TYPE", "ANC_DATE", "END_DATE")


def _joined(alias: str, table_name: str, condition: str) -> str:
    on = " AND ".join(f"k.{c} IS NOT DISTINCT FROM {alias}.{c}" for c in _KEYS)
    return f"LEFT JOIN (SELECT * FROM {table_name} WHERE {condition}) {alias} ON {on}"


_MERGED, _ANNUAL = "RPT_TYPE = '003'", "RPT_TYPE = '003' AND RPT_TERM_TYPE = '004'"

dataset_query(
    "FinancialIndicator",
    "INFO_PARTY_FIN_BALANCE INFO_PARTY_FIN_INCOME INFO_PARTY_FIN_CASHFLOW INFO_PARTY_FIN_INDDRV",
    f""",
derived AS (SELECT * RENAME (ANC_DATE_LAT AS ANC_DATE) FROM INFO_PARTY_FIN_INDDRV),
keys AS (
  SELECT {", ".join(_KEYS)} FROM INFO_PARTY_FIN_BALANCE WHERE {_MERGED}
  UNION SELECT {", ".join(_KEYS)} FROM INFO_PARTY_FIN_INCOME WHERE {_ANNUAL}
  UNION SELECT {", ".join(_KEYS)} FROM INFO_PARTY_FIN_CASHFLOW WHERE {_ANNUAL}
  UNION SELECT {", ".join(_KEYS)} FROM derived
)
SELECT k.PARTY_CODE AS issuer_code, k.RPT_TYPE AS report_type, k.RPT_TERM_TYPE AS reporting_period_type,
       k.ANC_DATE AS trade_date, k.END_DATE AS due_date, LIAB_NONCUR AS total_non_current_liabilities,
       LIAB_TTL AS total_liabilities, AST_TTL AS total_assets, MNY_FUND AS monetary_fund,
       FIN_AST_TRAS AS held_for_trading_financial_assets, RCV_NOTE AS notes_receivable,
       OE_TTL AS total_investors_equity, OE_MINOR AS minority_interest, INC_BIZ AS perating_income,
       NET_PFT AS net_return, TTL_PFT AS total_profit, PAY_OBT_FIOLTA AS cash_paid_for_long_term_assets,
       RECP_DISP_FIOLTA AS net_cash_recovered, ICF AS investment_activities_cash_flow, OCF AS ocf,
       ICR_CASH_EQLT AS net_increase_in_equivalents, CASH_EQLT_EOP AS equivalents_balance,
       EPS_DIL_OP AS operating_profit, ROA / 100.0e0 AS return_on_total_assets_float,
       GRO_PRO_MAR / 100.0e0 AS gross_profit_margin_float, GRO_MAR AS total_operating_income,
       ASS_RN AS total_assets_turnover, STM_IS AS amortization_and_accrual,
       EXI_CUR AS interest_free_current_liabilities, EXI_NON AS interest_free_non_current_liabilities,
       ORPS AS earnings_per_share, EBIT AS ebit
FROM keys k {_joined("b", "INFO_PARTY_FIN_BALANCE", _MERGED)} {_joined("i", "INFO_PARTY_FIN_INCOME", _ANNUAL)}
{_joined("c", "INFO_PARTY_FIN_CASHFLOW", _ANNUAL)} {_joined("d", "derived", "true")}""",
)

for _name, _table in PANEL_TABLES.items():
    dataset_query(_name, _table, f"""
SELECT instrument_code, CAST(trade_date AS DATE) AS trade_date, size, beta, momentum FROM {_table}""")

_SYSTEM, _OWN = "PLATO_CS_PRD_ASSET_CLS_SYS", "PLATO_CS_PRD_ASSET_CLS_UD"

dataset_query("AssetClassification", f"{_SYSTEM} {_SYSTEM}_TYPE {_OWN} {_OWN}_TYPE", f"""
SELECT s.CLS_TYPE AS cls_type, s.CLS_CODE AS cls_code, s.CLS_NAME AS cls_name
FROM {_SYSTEM} s JOIN {_SYSTEM}_TYPE t ON s.CLS_TYPE = t.CLS_TYPE_CODE
UNION
SELECT u.CLS_TYPE_CODE, u.CLS_CODE, u.CLS_NAME
FROM {_OWN} u JOIN {_OWN}_TYPE t ON u.CLS_TYPE_CODE = t.CLS_TYPE_CODE""")

dataset_query(
    "AssetClassificationRelation",
    f"PLATO_CS_PRD_STR_CLS {_SYSTEM} {_OWN}",
    f"""
SELECT SECU_CODE AS instrument_code, SYMBOL AS symbol, SECU_NAME AS instrument_name, s.CLS_TYPE AS cls_type,
       l.CLS_CODE AS cls_code, l.CLS_NAME AS cls_name
FROM PLATO_CS_PRD_STR_CLS l JOIN {_SYSTEM} s ON s.CLS_CODE = l.CLS_CODE
UNION ALL
SELECT SECU_CODE, SYMBOL, SECU_NAME, u.CLS_TYPE_CODE, u.CLS_CODE, u.CLS_NAME
FROM PLATO_CS_PRD_STR_CLS l JOIN {_OWN} u ON u.CLS_CODE = l.CLS_CODE""",
)

_CURVE_MOVES = " UNION ALL ".join(
    f"SELECT SCENE_FACTOR_REL_ID AS rel, TYPE, '{tenor}' AS tenor, {column} AS v "
    "FROM PLATO_CFG_SCENE_FACTOR_REL_CURVE"
    for column, tenor in CURVE_TENORS.items()
)

dataset_query(
    "ScenarioDef",
    "PLATO_CFG_SCENE PLATO_CFG_SCENE_FACTOR_SINGLE_REL PLATO_CFG_SCENE_FACTOR_REL_CURVE PLATO_CFG_FACTOR",
    f""",
moves AS (
  SELECT r.ID AS rel, replace(r.TRADING_DATE, '-', '') AS trade_date, s.ID AS scene_id, f.FACTOR_CODE AS index,
         CAST(r.FACTOR_TYPE AS BIGINT) AS factor_type, r.FACTOR_NAME AS factor_name,
         r.MODIFICATION_TYPE AS modification_type, r.MODIFICATION_VALUE AS v
  FROM PLATO_CFG_SCENE s JOIN PLATO_CFG_SCENE_FACTOR_SINGLE_REL r ON s.ID = r.SCENE_ID
  JOIN PLATO_CFG_FACTOR f ON f.ID = r.FACTOR_ID
), curve_moves AS ({_CURVE_MOVES})
SELECT trade_date, scene_id, index, factor_type, factor_name, modification_type, tenor, c.v AS modification_value
FROM moves JOIN curve_moves c USING (rel) WHERE c.TYPE = 2 AND c.v IS NOT NULL
UNION ALL
SELECT trade_date, scene_id, index, factor_type, factor_name, modification_type, NULL, v
FROM moves WHERE factor_type <> 2""",
)


def _rated_sql(ratings: str, code: str, key: str, where: str, bucket: str) -> str:
    return with_sources(ratings, f""",
latest AS (
  SELECT {code} AS code, ANC_DATE AS day,
         arg_max(CREDIT_RAT, struct_pack(o := RAT_ORG, r := CREDIT_RAT)) AS rating
  FROM {ratings} {where} GROUP BY 1, 2
), held AS (
  SELECT event_id, '{key}' || CAST(user_id AS STRING) AS code, CAST(ts AS DATE) AS day FROM events
)
SELECT event_id, held.code, held.day, rating{bucket}
FROM held ASOF LEFT JOIN latest ON held.code = latest.code AND held.day >= latest.day""")


def _held(spark, sf_dir, key, name):
    return table(spark, sf_dir, "events").select(
        "event_id", F.concat(F.lit(key), F.col("user_id").cast("string")).alias(name), day("ts").alias("trade_date")
    )


@query(
    _rated_sql(
        "INFO_FI_BONDRATING", "BOND_CODE", "P",
        "WHERE RAT_ORG IN ('002', '003', '004', '005', '006', '034', '013', '014', '019')",
        ", CASE WHEN rating IS NOT NULL THEN 'AA' END AS rating_type",
    ),
    dates="day",
)
def rate_instruments(spark, sf_dir):
    ratings = build_dataset("InstrumentRating", BuildContext(bound_sources(spark, sf_dir)))
    rated = classes.rate_instruments(_held(spark, sf_dir, "P", "instrument_code"), ratings)
    return rated.withColumnsRenamed({"instrument_code": "code", "trade_date": "day"})


@query(_rated_sql("INFO_PARTY_RATING", "PARTY_CODE", "I", "", ""), dates="day")
def rate_issuers(spark, sf_dir):
    ratings = build_dataset("IssuerRating", BuildContext(bound_sources(spark, sf_dir)))
    rated = classes.rate_issuers(_held(spark, sf_dir, "I", "issuer_code"), ratings)
    return rated.withColumnsRenamed({"issuer_code": "code", "trade_date": "day"})
