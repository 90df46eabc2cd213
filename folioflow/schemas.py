"""The stored datasets: fields, types, source columns, partitioning.

Each field line reads `name  type  source  | description`. A source is `COLUMN` of the main
table, `TABLE.COLUMN`, several joined by `+`, or `-` for a computed field. The lineage is kept
in the field metadata and survives a parquet round trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "strings": T.ArrayType(T.StringType()),
    "doubles": T.ArrayType(T.DoubleType()),
}


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    category: str
    schema: T.StructType | None
    main_table: str | None = None
    partition_by: tuple[str, ...] = ()
    grain: str | None = None
    max_rows_per_file: int | None = None
    sort_within: tuple[str, ...] = ()


def _field(line: str, main_table: str | None) -> T.StructField:
    head, _, description = line.partition("|")
    name, kind, source = head.split()
    metadata = {"description": description.strip()} if description.strip() else {}
    sources = [s.rpartition(".") for s in source.split("+")] if source != "-" else []
    if len(sources) > 1:
        metadata["source_table"] = {t or main_table: c for t, _, c in sources}
    elif sources:
        table, _, column = sources[0]
        metadata["table_field"] = column
        if table:
            metadata["table_name"] = table
    return T.StructField(name, _TYPES[kind], True, metadata)


def _spec(category: str, name: str, main_table: str | None, fields: str, **options) -> DatasetSpec:
    lines = [line for line in fields.strip().splitlines() if line.strip()]
    schema = T.StructType([_field(line, main_table) for line in lines])
    return DatasetSpec(name, category, schema, main_table, **options)


# Dataset fields with their source tables and columns.

BENCHMARK_INFO = _spec("Instrument", "BenchMarkInfo", "PERFORMANCE_BENCHMARKS", """
instrument_code  string  PERFORMANCE_BENCHMARK_CODE  | benchmark code
instrument_name  string  PERFORMANCE_BENCHMARK_NAME  | benchmark name
instrument_type  string  -                           | kind of instrument
""")

BOND_INFO = _spec("Instrument", "BondInfo", "INFO_FI_BASICINFO", """
instrument_code                string   INFO_FI_BASICINFO.BOND_CODE+INFO_FI_ADVANCE_REPAY.BOND_CODE+INFO_FI_RIT_EMB_XCS.BOND_CODE+INFO_FI_IR_DETAILED.BOND_CODE  | internal bond code
instrument_name                string   CSNAME          | short name
symbol                         string   BOND_SYMBOL     | traded code with market
bond_term_day                  double   BOND_TERM_DAY   | term in days
bond_term_year                 double   BOND_TERM_YEAR  | term in years
par_value_iss                  double   PAR_VALUE_ISS   | par value at issue
market                         string   EXCH_CODE       | exchange
estimated_maturity_date        date     XPC_DUE_DATE    | expected maturity
maturity_date                  date     ACT_DUE_DATE    | actual maturity
iss_start_date                 date     ISS_START_DATE  | first issue day
day_count                      string   INT_RULE        | day count rule
start_date                     date     VALUE_DATE      | first day of interest
issue_price                    double   ISS_PRICE       | price at issue
issuer_code                    string   PARTY_CODE      | issuer
par_rate_issue                 double   PAR_ANN_IR      | coupon at issue
coupon_type                    string   CPN_TYPE        | how coupons are paid
interest_rate_type             string   IR_TYPE         | fixed or floating
benchmark_code                 string   FLT_BM_CODE     | benchmark of a floater
spread                         double   FLT_IR_SPRD     | spread of a floater
pay_frequency                  string   PAY_FREQ        | coupons per year
ann_ir_floor                   double   ANN_IR_FLOOR    | guaranteed rate
calc_way                       long     INT_FML         | interest for periods under a year
frn_adjust_rate                long     INT_ADJ_MODE    | when a floater resets
par_value                      double   INFO_FI_BONDISSUE.PAR_VALUE  | par value
reference_rate_issue           double   INFO_FI_BONDISSUE.REF_FLD    | reference yield at issue
instrument_type                string   -               | kind of instrument
coupon_accuracy                long     -               | decimals of a coupon
is_create_new                  long     -               | build the benchmark anew
notional_reduce_map            string   -               | JSON: date to share repaid
call_option_map                string   -               | JSON: date to call price
put_option_map                 string   -               | JSON: date to put price
high_interest_rate_adj         string   -               | JSON: date to highest adjustment
low_interest_rate_adj          string   -               | JSON: date to lowest adjustment
adjust_num_for_lastest         double   -               | days from first period to interest start
interest_start_date            strings  -               | period starts
interest_end_date              strings  -               | period ends
interest_period_interest_rate  doubles  -               | period rates
coupon_change_map              string   -               | JSON: period start to rate
delist_date                    date     DELIST_DATE     | last listed day
float_rate_records             doubles  -               | five floater settings
CLS_CODE_1ST                   string   INFO_ZG_SEC_CLASSIFICATION.CLS_CODE_1ST  | credit class, level 1
CLS_CODE_2ND                   string   INFO_ZG_SEC_CLASSIFICATION.CLS_CODE_2ND  | credit class, level 2
CLS_CODE_3RD                   string   INFO_ZG_SEC_CLASSIFICATION.CLS_CODE_3RD  | credit class, level 3
CLS_CODE_4TH                   string   INFO_ZG_SEC_CLASSIFICATION.CLS_CODE_4TH  | credit class, level 4
""", max_rows_per_file=100_000)

FUND_INFO = _spec("Instrument", "FundInfo", "PROD_FUNDS", """
instrument_code  string  PROD_FUNDS.FUND_CODE+INFO_FUND_BASICINFO.FUND_CODE  | product code
instrument_name  string  PROD_FUNDS.FUND_NAME+INFO_FUND_BASICINFO.CSNAME     | product name
delist_date      date    INFO_FUND_BASICINFO.DELIST_DATE                     | last listed day
instrument_type  string  -                                                   | kind of instrument
""")

STOCK_INDEX_INFO = _spec("Instrument", "StockIndexInfo", "INFO_IDX_BASICINFO", """
instrument_code  string  IDX_CODE  | internal index code
instrument_name  string  CNAME     | index name
symbol           string  SYMBOL    | published code
instrument_type  string  -         | kind of instrument
""")

STOCK_INFO = _spec("Instrument", "StockInfo", "INFO_STK_BASICINFO", """
instrument_code  string  STK_CODE     | internal stock code
symbol           string  SYMBOL       | traded code
issuer_code      string  PARTY_CODE   | company
list_status      string  LIST_STATUS  | listing state
list_date        string  LIST_DATE    | first listed day, empty if none
delist_date      string  DELIST_DATE  | last listed day, empty if none
exchange_code    string  EXCH_CODE    | exchange
instrument_type  string  -            | kind of instrument
index            string  LIST_BRD     | index of the board
index_name       string  LIST_BRD     | name of that index
sec_type         string  SEC_TYPE     | security type
""")

BENCHMARK_DAILY_INDUSTRY_RETURN = _spec("MarketData", "BenchmarkDailyIndustryReturn", "INDIC_DERI_BHMARK_INDU", """
weight             double  INDU_WT_RAT      | weight of the industry
trade_date         date    BUSI_DATE        | day
instrument_code    string  INDU_CODE_1ST    | industry code
instrument_name    string  INDU_NAME_1ST    | industry name
return_rate        double  INDU_RETURN_RAT  | return of the industry
benchmark_code     string  BMARK_CODE       | benchmark
industry_sys_code  string  INDU_SYS_CODE    | classification system
""")

BENCHMARK_DAILY_QUOTE = _spec("MarketData", "BenchmarkDailyQuote", "INFO_IDX_EODVALUE", """
trade_date         date    TRD_DATE  | day
close              double  CLS_PRC   | closing level
return_percentage  double  PCT_CHG   | change as a ratio
instrument_code    string  IDX_CODE  | internal index code
""", grain="month")

BOND_DAILY_QUOTE = _spec("MarketData", "BondDailyQuote", "INFO_FI_EODPRICE", """
instrument_code  string  BOND_CODE   | bond
trade_date       date    TRD_DATE    | day
volume           double  VOL         | volume
trade_amount     double  AMT_NET     | amount at clean price
high             double  HI_NET_PRC  | highest clean price
low              double  LO_NET_PRC  | lowest clean price
turnover         double  TURN_RAT    | turnover
""", grain="month")

BOND_VAL_CNBD = _spec("MarketData", "BondValCNBD", "INFO_FI_VAL_CNBD", """
instrument_code       string  BOND_CODE  | bond
trade_date            date    TRD_DATE   | day
remn_term             double  RMN_YEAR   | years left
ytm                   double  YIELD      | yield as a ratio
duration              double  MODIF_DUR  | modified duration
valuation_net_price   double  NET_PRC    | clean price
valuation_full_price  double  FULL_PRC   | full price
interest              double  INFO_FI_CASHFLOW.PAY_INT       | interest paid that day
principal             double  INFO_FI_CASHFLOW.PRCP_CASH     | principal paid that day
val_type              string  VAL_TYPE   | kind of valuation
is_rcm                string  IS_RCM     | recommended
cash_amt_aft          double  INFO_FI_CASHFLOW.CASH_AMT_AFT  | principal left
acr_int               double  ACR_INT    | accrued interest
""", sort_within=("instrument_code", "trade_date"), grain="month")

BOND_VAL_CSI = _spec("MarketData", "BondValCSI", "INFO_FI_VAL_CSI", """
instrument_code       string  BOND_CODE  | bond
trade_date            date    TRD_DATE   | day
ytm                   double  YIELD      | yield as a ratio
duration              double  MODIF_DUR  | modified duration
valuation_net_price   double  NET_PRC    | clean price
valuation_full_price  double  FULL_PRC   | full price
interest              double  INFO_FI_CASHFLOW.PAY_INT    | interest paid that day
principal             double  INFO_FI_CASHFLOW.PRCP_CASH  | principal paid that day
rcm_dir               string  RCM_DIR    | recommended direction
""", sort_within=("instrument_code", "trade_date"), grain="month")

FI_YIELD_CURVE = _spec("MarketData", "FiYieldCurve", "INFO_FI_CFETS_YIELD_CURV", """
trade_date       date    TRD_DATE    | day
std_term         double  STD_TERM    | term in years
ytm              double  YIELD       | yield in percent
curve_type       string  CURV_TYPE   | kind of curve
curve_type_name  string  CURV_CNAME  | curve name
curve_code       string  CURV_CODE   | curve
""")

FUND_DAILY_QUOTE = _spec("MarketData", "FundDailyQuote", "INFO_FUND_EODPRICE", """
instrument_code                 string  INFO_FUND_EODPRICE.FUND_CODE+INDIC_BASE_PORT_IDX.PRD_CODE  | product
trade_date                      date    INFO_FUND_EODPRICE.END_DATE+INDIC_BASE_PORT_IDX.BIZ_DATE   | day
volume                          double  VOL       | volume
trade_amount                    double  AMT       | amount
high                            double  HI_PRC    | highest price
low                             double  LO_PRC    | lowest price
close                           double  INFO_FUND_EODPRICE.CLS_PRC+INDIC_BASE_PORT_IDX.UNIT_NAV  | closing price or unit value
turnover                        double  TURN_RAT  | turnover
return_percentage               double  INFO_FUND_EODPRICE.PCT_CHG+INDIC_DERI_PORT_PRFT_IDX.DAY_UNIT_NAV_GROW_RATE  | change as a ratio
close_adjusted                  double  INFO_FUND_EODPRICE.CLS_PRC_ADJ+INDIC_BASE_PORT_IDX.ADJ_UNIT_NAV  | adjusted price or value
return_percentage_adjusted      double  -         | change of the adjusted value
return_percentage_adjusted_log  double  -         | log of that change
""", grain="month")

FX_EXCH_RATE = _spec("MarketData", "FxExchRate", "INFO_FX_EXCHRATE", """
fx_code     string  FX_CODE   | currency pair
exch_rate   double  EXCH_PRC  | price of the pair
trade_date  date    END_DATE  | day
prc_type    string  PRC_TYPE  | kind of price
pub_org     string  PUB_ORG   | publisher
""")

INDEX_RATE = _spec("MarketData", "IndexRate", None, """
index            string  INFO_FI_CNBD_YIELD_CURV.CURV_CODE+INFO_FI_GLOBAL_IBOR.IR_CODE+INFO_FI_BNK_DL_IR.IR_CODE+INFO_FI_IR_BASICINFO.IRCODE  | curve or rate
index_name       string  INFO_FI_CNBD_YIELD_CURV.CURV_CNAME+INFO_FI_GLOBAL_IBOR.CNAME+INFO_FI_BNK_DL_IR.CNAME  | its name
trade_date       date    INFO_FI_CNBD_YIELD_CURV.TRD_DATE+INFO_FI_GLOBAL_IBOR.TRD_DATE+INFO_FI_BNK_DL_IR.CHG_START_DATE  | day
tenor            string  INFO_FI_CNBD_YIELD_CURV.STD_TERM    | term label
tenor2           string  INFO_FI_CNBD_YIELD_CURV.FWD_TERM_N  | forward term label
rate             double  INFO_FI_CNBD_YIELD_CURV.YIELD+INFO_FI_BNK_DL_IR.INTR_RAT+INFO_FI_GLOBAL_IBOR.INTR_RAT  | rate as a ratio
currency         string  -                         | currency
instrument_type  string  -                         | kind of instrument
curve_type       string  INFO_FI_IR_BASICINFO.IRTYPE  | kind of curve
curve_type_name  string  INFO_PARA_INFO.PARA_NAME  | its name
""", grain="month")

INDUSTRY_CLASSIFICATION = _spec("MarketData", "IndustryClassificationMktData", "INFO_PARTY_INDUSTRY", """
issuer_code    string  PARTY_CODE     | company
trade_date     date    START_DATE     | valid from
industry_code  string  INDU_SYS_CODE  | classification system
sector_code    string  INDU_CODE_1ST  | sector
sector_name    string  INDU_NAME_1ST  | sector name
industry_name  string  INFO_PARA_INFO.PARA_NAME  | system name
""")

INSTRUMENT_RATING = _spec("MarketData", "InstrumentRating", "INFO_FI_BONDRATING", """
instrument_code      string  BOND_CODE   | bond
rating               string  CREDIT_RAT  | rating
trade_date           date    ANC_DATE    | announced on
rating_organization  string  RAT_ORG     | agency
""")

ISSUER_RATING = _spec("MarketData", "IssuerRating", "INFO_PARTY_RATING", """
issuer_code          string  PARTY_CODE  | company
rating               string  CREDIT_RAT  | rating
trade_date           date    ANC_DATE    | announced on
rating_organization  string  RAT_ORG     | agency
""")

CALENDAR = _spec("MarketData", "Calendar", "CALENDAR_DATES", """
scope          string  -              | default calendar or all
calendar_id    string  CALENDAR_ID    | calendar
calendar_date  date    CALENDAR_DATE  | business day
""")

STOCK_DAILY_QUOTE = _spec("MarketData", "StockDailyQuote", "INFO_STK_EODPRICE", """
issuer_code                      string  INFO_STK_BASICINFO.PARTY_CODE+INFO_PARTY_SHRSTRUC.PARTY_CODE  | company
close_adjusted                   double  CLS_PRC_ADJ      | adjusted close
prev_close_adjusted              double  PRE_CLS_PRC_ADJ  | adjusted close of the day before
return_percentage                double  PCT_CHG          | change as a ratio
trade_date                       date    END_DATE         | day
instrument_code                  string  STK_CODE         | stock
trade_amount                     double  AMT              | amount
volume                           double  VOL              | volume
high                             double  HI_PRC           | highest price
low                              double  LO_PRC           | lowest price
turnover                         double  TURN_RAT         | turnover
close                            double  CLS_PRC          | close
prev_close                       double  PRE_CLS_PRC      | close of the day before
negotiable_market_capitalization double  INFO_STK_VALUATION.CV       | traded capitalization
market_capitalization            double  INFO_STK_VALUATION.MV       | capitalization
dividend_yield                   double  INFO_STK_VALUATION.DVD_YLD  | dividend yield as a ratio
preferred_stock                  double  INFO_PARTY_SHRSTRUC.SHR_PS    | preferred shares
due_date                         date    INFO_PARTY_SHRSTRUC.CHG_DATE  | share change day
shares_outstanding               double  INFO_PARTY_SHRSTRUC.SHR_TTL   | all shares
circulating_shares               double  INFO_PARTY_SHRSTRUC.SHR_CRC   | traded shares
return_percentage_adjusted       double  -                | change of the adjusted close
return_percentage_adjusted_log   double  -                | log of that change
""", grain="month")

TIME_SERIES = _spec("MarketData", "TimeSeries", None, """
index             string  -  | instrument, curve or rate
index_name        string  -  | its name
symbol            string  -  | published code
trade_date        date    -  | day
tenor             string  -  | term label, empty for prices
rate              double  -  | value of the series
currency          string  -  | currency
instrument_type   string  -  | kind of instrument
time_series_type  string  -  | kind of series
""", grain="month")

VOLATILITY_SURFACE = _spec("MarketData", "VolatilitySurface", "OPTION_VOLATILITY_SURFACE", """
instrument_code  string  ASSET_ID           | currency pair
trade_date       date    DATE               | day
volatility_type  string  VOLATILITY_TYPE    | kind of volatility
volatility       double  VOLATILITY         | volatility
tenor            double  TENOR              | term
forward_tenor    double  FORWARD_TENOR      | forward term
strike_price     double  STRIKE_PRICE       | strike
moneyness        string  MONEYNESS          | moneyness
instrument_name  string  ASSET_DESCRIPTION  | description
""")

YIELD_CURVE_SAMPLE = _spec("MarketData", "YieldCurveCNBDSample", "INFO_FI_YC_CNBD_SAMPLE", """
index            string  CURV_CODE   | curve
index_name       string  CURV_CNAME  | curve name
instrument_code  string  BOND_CODE   | sample bond
trade_date       date    TRD_DATE    | day
""")

BOND_POSITION = _spec("Portfolio", "BondPosition", "INDIC_BASE_BOND_POS_DTL", """
book_id              string   PRD_CODE        | book
currency             string   CUR_CODE        | currency
trade_date           date     BIZ_DATE        | day
instrument_code      string   SECU_CODE       | instrument
secu_type_code       string   SECU_TYPE_CODE  | security type
symbol               string   SYMBOL          | traded code
instrument_name      string   SECU_NAME       | name
unit_cost            double   UNIT_COST       | cost per unit
valuation_price      double   VAL_PRC         | valuation price
cost                 double   POS_COST        | quantity-weighted cost
market_value         double   POS_MKV         | market value
quantity             double   POS_QTY         | quantity
held_to_maturity     boolean  INVES_CLS_CODE  | held to maturity
market               string   TX_MKT_CODE     | market
rmn_cost             double   RMN_COST        | amortised cost
shadow_market_value  double   SHADOW_MKV      | shadow value
""")

COMB_ASSET = _spec("Portfolio", "CombAsset", "DM_PORT_ASSET", """
instrument_code          string  PRODUCT_CODE          | product
trade_date               date    BUSI_DATE             | day
close                    double  PE_NET_ASSET          | net assets
quantity                 double  PE_SHARES             | shares
net_cptl_inflow_amt      double  NET_CPTL_INFLOW_AMT   | net inflow
leverage_rate            double  LEVERAGE_RATE         | leverage
cash_ratio               double  CASH_RATIO            | cash share
inst_posi_rin            double  INST_POSI_RIN         | institutional share
realizable_market_value  double  ST_REALIZABLE_MKTVAL  | value that can be sold soon
market_value             double  MKTV_FUND             | value of funds held
down_flag                string  DOWN_FLAG             | looked through
""")

COMB_POSITION = _spec("Portfolio", "CombPosition", "INDIC_BASE_PORT_POS_DTL", """
book_id            string   PRD_CODE          | book
currency           string   CUR_CODE          | currency
trade_date         date     BIZ_DATE          | day
instrument_code    string   SECU_CODE         | instrument
secu_type_code     string   SECU_TYPE_CODE    | security type
symbol             string   SYMBOL            | traded code
instrument_name    string   SECU_NAME         | name
unit_cost          double   UNIT_COST         | cost per unit
valuation_price    double   VAL_PRC           | valuation price
cost               double   POS_COST          | quantity-weighted cost
market_value       double   POS_MKV           | market value
quantity           double   POS_QTY           | quantity
prev_quantity      double   -                 | quantity of the row before
prev_market_value  double   -                 | market value of the row before
prev_cost          double   -                 | cost of the row before
held_to_maturity   boolean  INVES_CLS_CODE    | held to maturity
instrument_type    string   AST_BIG_CLS_CODE  | kind of instrument
market             string   TX_MKT_CODE       | market
remn_term          double   INDIC_BASE_REPO_POS_DTL.REMN_TERM  | cost-weighted term of repos
""")

COMB_POSITION_PENETRATE = _spec("Portfolio", "CombPositionPenetrate", "INDIC_BASE_PORT_POS_DTL", """
book_id            string   PRD_CODE          | top book
currency           string   CUR_CODE          | currency
trade_date         date     BIZ_DATE          | day
instrument_code    string   SECU_CODE         | instrument
secu_type_code     string   SECU_TYPE_CODE    | security type
symbol             string   SYMBOL            | traded code
instrument_name    string   SECU_NAME         | name
instrument_type    string   AST_BIG_CLS_CODE  | kind of instrument
market_value       double   POS_MKV           | share of market value
quantity           double   POS_QTY           | share of quantity
unit_cost          double   UNIT_COST         | cost per unit
cost               double   POS_COST          | share of cost
prev_quantity      double   -                 | quantity of the row before
prev_market_value  double   -                 | market value of the row before
prev_cost          double   -                 | cost of the row before
valuation_price    double   VAL_PRC           | valuation price
held_to_maturity   boolean  INVES_CLS_CODE    | held to maturity
market             string   TX_MKT_CODE       | market
remn_term          double   INDIC_BASE_REPO_POS_DTL.REMN_TERM  | cost-weighted term of repos
""")

DOWN_RELATION = _spec("Portfolio", "DownRelationPortfolio", "INDIC_DOWN_RELATION", """
book_id           string  PRODUCT_CODE    | owning book
trade_date        date    VALUATION_DATE  | day
children_book_id  string  SECU_CODE       | book held
invest_rate       double  INVEST_RATE     | share held
""")

STOCK_INDEX_PORTFOLIO = _spec("Portfolio", "StockIndexPortfolio", "INFO_IDX_WT_STK", """
book_id          string  IDX_CODE  | index
trade_date       date    TRD_DATE  | day
instrument_code  string  CPN_CODE  | member
quantity         double  WT        | weight as a ratio
""", grain="month")

BOND_TRADE = _spec("TradeInfo", "BondTradeInfo", "INDIC_BASE_TX_BOND", """
book_id            string  PRD_CODE      | book
trade_date         date    TX_DATE       | day
instrument_code    string  SECU_CODE     | bond
notional           double  TRAN_QTY      | signed quantity
trade_amount       double  TRAN_NET_AMT  | signed amount at clean price
settlement_amount  double  ACTL_STL_AMT  | signed settled amount
acr_int            double  INT_AMT       | accrued interest
""")

BOND_TRADE_PENETRATE = _spec("TradeInfo", "BondTradePenetrateInfo", None, """
book_id            string  -  | top book
trade_date         date    -  | day
instrument_code    string  -  | bond
notional           double  -  | change of quantity
trade_amount       double  -  | change of cost
settlement_amount  double  -  | change of cost
trading_fee        double  -  | zero
""")

STOCK_TRADE = _spec("TradeInfo", "StockTradeInfo", "INDIC_BASE_TX_STOCK", """
book_id          string  PRD_CODE   | book
trade_date       date    CLR_DATE   | day
instrument_code  string  SECU_CODE  | stock
trading_fee      double  TX_FEE     | fees of both sides
notional         double  TRAN_QTY   | bought minus sold quantity
buy_amount       double  TRAN_AMT   | bought amount
sell_amount      double  TRAN_AMT   | sold amount
""")

STOCK_TRADE_PENETRATE = _spec("TradeInfo", "StockTradePenetrateInfo", None, """
book_id          string  -  | top book
trade_date       date    -  | day
instrument_code  string  -  | stock
notional         double  -  | change of quantity
buy_amount       double  -  | change of cost if not negative
sell_amount      double  -  | change of cost if negative, with its sign
trading_fee      double  -  | zero
""")

_STATEMENT_TABLES = (
    "INFO_PARTY_FIN_BALANCE",
    "INFO_PARTY_FIN_INCOME",
    "INFO_PARTY_FIN_INDDRV",
    "INFO_PARTY_FIN_CASHFLOW",
)


def _in_all_statements(column: str) -> str:
    return "+".join(f"{table}.{column}" for table in _STATEMENT_TABLES)


FINANCIAL_INDICATOR = _spec("Factor", "FinancialIndicator", None, f"""
issuer_code                            string  {_in_all_statements("PARTY_CODE")}     | company
report_type                            string  {_in_all_statements("RPT_TYPE")}       | kind of report
reporting_period_type                  string  {_in_all_statements("RPT_TERM_TYPE")}  | kind of period
trade_date                             date    {_in_all_statements("ANC_DATE")}       | published on
due_date                               date    {_in_all_statements("END_DATE")}       | period end
total_non_current_liabilities          double  INFO_PARTY_FIN_BALANCE.LIAB_NONCUR     | non-current liabilities
total_liabilities                      double  INFO_PARTY_FIN_BALANCE.LIAB_TTL        | liabilities
total_assets                           double  INFO_PARTY_FIN_BALANCE.AST_TTL         | assets
monetary_fund                          double  INFO_PARTY_FIN_BALANCE.MNY_FUND        | cash
held_for_trading_financial_assets      double  INFO_PARTY_FIN_BALANCE.FIN_AST_TRAS    | trading assets
notes_receivable                       double  INFO_PARTY_FIN_BALANCE.RCV_NOTE        | notes receivable
total_investors_equity                 double  INFO_PARTY_FIN_BALANCE.OE_TTL          | equity
minority_interest                      double  INFO_PARTY_FIN_BALANCE.OE_MINOR        | minority interest
perating_income                        double  INFO_PARTY_FIN_INCOME.INC_BIZ          | operating income
net_return                             double  INFO_PARTY_FIN_INCOME.NET_PFT          | net profit
total_profit                           double  INFO_PARTY_FIN_INCOME.TTL_PFT          | profit before tax
cash_paid_for_long_term_assets         double  INFO_PARTY_FIN_CASHFLOW.PAY_OBT_FIOLTA   | paid for long-term assets
net_cash_recovered                     double  INFO_PARTY_FIN_CASHFLOW.RECP_DISP_FIOLTA | received for long-term assets
investment_activities_cash_flow        double  INFO_PARTY_FIN_CASHFLOW.ICF            | investing cash flow
ocf                                    double  INFO_PARTY_FIN_CASHFLOW.OCF            | operating cash flow
net_increase_in_equivalents            double  INFO_PARTY_FIN_CASHFLOW.ICR_CASH_EQLT  | change of cash
equivalents_balance                    double  INFO_PARTY_FIN_CASHFLOW.CASH_EQLT_EOP  | cash at the end
operating_profit                       double  INFO_PARTY_FIN_INDDRV.EPS_DIL_OP       | diluted operating earnings per share
return_on_total_assets_float           double  INFO_PARTY_FIN_INDDRV.ROA              | return on assets as a ratio
gross_profit_margin_float              double  INFO_PARTY_FIN_INDDRV.GRO_PRO_MAR      | gross margin as a ratio
total_operating_income                 double  INFO_PARTY_FIN_INDDRV.GRO_MAR          | total operating income
total_assets_turnover                  double  INFO_PARTY_FIN_INDDRV.ASS_RN           | asset turnover
amortization_and_accrual               double  INFO_PARTY_FIN_INDDRV.STM_IS           | depreciation and amortisation
interest_free_current_liabilities      double  INFO_PARTY_FIN_INDDRV.EXI_CUR          | interest-free current liabilities
interest_free_non_current_liabilities  double  INFO_PARTY_FIN_INDDRV.EXI_NON          | interest-free non-current liabilities
earnings_per_share                     double  INFO_PARTY_FIN_INDDRV.ORPS             | operating income per share
ebit                                   double  INFO_PARTY_FIN_INDDRV.EBIT             | earnings before interest and tax
""", grain="month")

ASSET_CLASSIFICATION = _spec("Asset", "AssetClassification", None, """
cls_type  string  PLATO_CS_PRD_ASSET_CLS_SYS.CLS_TYPE+PLATO_CS_PRD_ASSET_CLS_UD.CLS_TYPE_CODE  | classification
cls_code  string  PLATO_CS_PRD_ASSET_CLS_SYS.CLS_CODE+PLATO_CS_PRD_ASSET_CLS_UD.CLS_CODE       | class
cls_name  string  PLATO_CS_PRD_ASSET_CLS_SYS.CLS_NAME+PLATO_CS_PRD_ASSET_CLS_UD.CLS_NAME       | class name
""")

ASSET_CLASSIFICATION_RELATION = _spec("Asset", "AssetClassificationRelation", "PLATO_CS_PRD_STR_CLS", """
instrument_code  string  SECU_CODE  | instrument
symbol           string  SYMBOL     | traded code
instrument_name  string  SECU_NAME  | name
cls_type         string  PLATO_CS_PRD_ASSET_CLS_SYS.CLS_TYPE+PLATO_CS_PRD_ASSET_CLS_UD.CLS_TYPE_CODE  | classification
cls_code         string  CLS_CODE   | class
cls_name         string  CLS_NAME   | class name
""")

SCENARIO_DEF = _spec("Scenario", "ScenarioDef", "PLATO_CFG_SCENE", """
trade_date          string  PLATO_CFG_SCENE_FACTOR_SINGLE_REL.TRADING_DATE       | day as yyyyMMdd
scene_id            string  PLATO_CFG_SCENE.ID                                   | scenario
index               string  PLATO_CFG_FACTOR.FACTOR_CODE                         | factor
factor_type         long    PLATO_CFG_SCENE_FACTOR_SINGLE_REL.FACTOR_TYPE        | kind of factor
factor_name         string  PLATO_CFG_SCENE_FACTOR_SINGLE_REL.FACTOR_NAME        | factor name
modification_type   string  PLATO_CFG_SCENE_FACTOR_SINGLE_REL.MODIFICATION_TYPE  | how the factor moves
tenor               string  -                                                    | term label of a curve point
modification_value  double  PLATO_CFG_SCENE_FACTOR_SINGLE_REL.MODIFICATION_VALUE | size of the move
""")

# Factor panels, stored as they come.
PANEL_TABLES = {
    "BarraLevel1": "INFO_BARRA_EXPOSURE",
    "BarraLevel2": "INFO_BARRA_LEVEL2",
    "BarraLevel2Mean": "INFO_BARRA_LEVEL2_MEAN",
    "BarraLevel2Std": "INFO_BARRA_LEVEL2_STD",
    "BarraLevel3": "INFO_BARRA_LEVEL3",
    "BarraLevel3Mean": "INFO_BARRA_LEVEL3_MEAN",
    "BarraLevel3Std": "INFO_BARRA_LEVEL3_STD",
    "BarraCne5Level1": "INFO_BARRA_EXPOSURE_CNE5",
    "BarraFactorReturnCne5": "INFO_BARRA_FACTOR_RETURN_CNE5",
    "BarraFactorReturnCne6": "INFO_BARRA_FACTOR_RETURN_CNE6",
}

_DECLARED = [value for value in list(globals().values()) if isinstance(value, DatasetSpec)]
_PANELS = [DatasetSpec(name, "Factor", None, table) for name, table in PANEL_TABLES.items()]

DATASETS = {spec.name: spec for spec in _DECLARED + _PANELS}
CATEGORIES = tuple(dict.fromkeys(spec.category for spec in DATASETS.values()))
