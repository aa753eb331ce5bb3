"""Declared schemas and the fixed field lists of the landing formats."""

from __future__ import annotations

from pyspark.sql import types as T

LINEAGE = ["ingested_at", "source_system", "source_api", "batch_id"]

# Field names of a quote line, by position.
QUOTE_FIELDS = [
    "version", "name", "code", "current_price", "last_close",
    "open", "volume", "outer_disc", "inner_disc",
    "bid1_price", "bid1_volume", "bid2_price", "bid2_volume",
    "bid3_price", "bid3_volume", "bid4_price", "bid4_volume",
    "bid5_price", "bid5_volume",
    "ask1_price", "ask1_volume", "ask2_price", "ask2_volume",
    "ask3_price", "ask3_volume", "ask4_price", "ask4_volume",
    "ask5_price", "ask5_volume",
    "latest_trade", "update_time", "change", "change_pct",
    "high", "low", "price_vol_amt", "volume_hand", "amount_wan",
    "turnover_rate", "pe_ttm", "unknown_40", "high_dup", "low_dup",
    "amplitude", "circ_market_cap", "total_market_cap", "pb",
    "limit_up", "limit_down", "volume_ratio", "bid_ask_diff",
    "avg_price", "pe_dynamic", "pe_static",
    "unknown_54", "unknown_55", "unknown_56", "amount_wan_hp",
    "unknown_58", "unknown_59", "unknown_60",
    "stock_type", "speed_pct", "change_pct_5min", "change_pct_ytd",
    "unknown_65", "unknown_66", "unknown_67", "unknown_68", "unknown_69",
    "dividend_yield_ttm", "unknown_71", "circ_shares", "total_shares",
    "unknown_74", "unknown_75", "unknown_76", "unknown_77", "unknown_78",
    "unknown_79", "unknown_80", "unknown_81",
    "currency", "listing_status", "event_mark",
    "unknown_85", "unknown_86", "tail",
]

# The measures of a financial statement row.
FINANCE_MEASURES = [
    "liutongguben", "zongguben", "guojiagu", "faqirenfarengu", "farengu",
    "bgu", "hgu", "zhigonggu",
    "zongzichan", "liudongzichan", "gudingzichan", "wuxingzichan",
    "gudongrenshu",
    "liudongfuzhai", "changqifuzhai", "zibengongjijin", "jingzichan",
    "zhuyingshouru", "zhuyinglirun", "yingshouzhangkuan", "yingyelirun",
    "touzishouyu", "jingyingxianjinliu", "zongxianjinliu", "cunhuo",
    "lirunzonghe", "shuihoulirun", "jinglirun", "weifenpeilirun",
    "meigujingzichan",
]

PRICES = ["open", "high", "low", "close"]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


STOCK_MAP = _struct(
    stock_code_id=T.LongType(), stock_code=T.StringType(), stock_name=T.StringType(),
    market=T.StringType(), ipo_date=T.DateType(), delist_date=T.DateType(),
)
DAILY = _struct(
    stock_code=T.StringType(), trade_date=T.DateType(), open=T.DoubleType(),
    high=T.DoubleType(), low=T.DoubleType(), close=T.DoubleType(),
    pre_close=T.DoubleType(), volume=T.LongType(), amount=T.DoubleType(),
    change_pct=T.DoubleType(),
)
ADJ_FACTOR = _struct(
    stock_code=T.StringType(), trade_date=T.DateType(), fenhong=T.DoubleType(),
    peigu_price=T.DoubleType(), songzhuangu=T.DoubleType(), peigu=T.DoubleType(),
    single_factor=T.DoubleType(),
)
MINUTE = _struct(
    stock_code=T.StringType(), datetime=T.TimestampNTZType(), open=T.DoubleType(),
    high=T.DoubleType(), low=T.DoubleType(), close=T.DoubleType(),
    vol=T.DoubleType(), amount=T.DoubleType(),
)
FINANCE = _struct(
    stock_code=T.StringType(), report_date=T.DateType(), ipo_date=T.DateType(),
    **{name: T.DoubleType() for name in FINANCE_MEASURES},
)
DOC = _struct(
    stock_code=T.StringType(), trade_date=T.DateType(), html=T.StringType(),
    file_size=T.LongType(), file_hash=T.StringType(), source_hash=T.StringType(),
)
DOC_SECTION = _struct(
    stock_code=T.StringType(), trade_date=T.DateType(), section_no=T.IntegerType(),
    name=T.StringType(), section_hash=T.StringType(), html=T.StringType(),
)
ADJ_STEP = T.StructType([
    T.StructField("stock_code", T.StringType()), T.StructField("from", T.DateType()),
    T.StructField("to", T.DateType()), T.StructField("factor_after", T.DoubleType()),
    T.StructField("factor_upto", T.DoubleType()),
])
ISSUE = _struct(
    level=T.StringType(), table=T.StringType(), stock_code=T.StringType(),
    trade_date=T.DateType(), column=T.StringType(), message=T.StringType(),
    raw_value=T.StringType(),
)
BUILD_RESULT = _struct(
    target=T.StringType(), mode=T.StringType(), status=T.StringType(),
    rows_read=T.LongType(), rows_written=T.LongType(), rows_rejected=T.LongType(),
    errors=T.ArrayType(T.StringType()), warnings=T.ArrayType(T.StringType()),
)
PLAN_LOG = _struct(
    plan_id=T.StringType(), action=T.StringType(), status=T.StringType(),
    started_at=T.TimestampNTZType(), finished_at=T.TimestampNTZType(),
)
STEP_LOG = _struct(
    plan_id=T.StringType(), step_name=T.StringType(), seq=T.IntegerType(), status=T.StringType(),
    rows=T.LongType(), failed=T.LongType(), n_errors=T.LongType(), n_failed_codes=T.LongType(),
    failed_codes=T.ArrayType(T.StringType()), errors=T.ArrayType(T.StringType()),
)
INDUSTRY = _struct(code=T.StringType(), name=T.StringType(), industry=T.StringType())
INGEST_RESULT = _struct(
    source=T.StringType(), table=T.StringType(), status=T.StringType(),
    rows=T.LongType(), total=T.LongType(), failed=T.LongType(),
    batch_id=T.StringType(), elapsed_ms=T.LongType(),
    errors=T.ArrayType(T.StringType()),
)
# payload of a K-line request: code -> series name -> list of cell lists
KLINE_PAYLOAD = _struct(
    code=T.IntegerType(),
    data=T.MapType(
        T.StringType(),
        T.MapType(T.StringType(), T.ArrayType(T.ArrayType(T.StringType()))),
    ),
)
