"""Fixed, nullable schemas of the engine's own records; what is absent is null."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DateType, DoubleType, IntegerType, StringType, StructField, StructType

_text, _texts = StringType(), ArrayType(StringType())


def _struct(**fields) -> StructType:
    return StructType([StructField(name.rstrip("_"), kind, True) for name, kind in fields.items()])


PERIOD = _struct(from_=DateType(), to=DateType())
DOCUMENT = _struct(
    _id=_text, filename=_text, country=_text, lang=_text, html=_texts, teststring=_text, wordlist=_texts, tourcodes=_texts, adhoc_tourcodes=_texts,
    faretype=_text, run_id=_text, sales_period=ArrayType(PERIOD), travel_period=ArrayType(PERIOD), carriers=_texts, currency=_text,
    classifications=_struct(commission=_text, filed=_text), predictions=_struct(commission=_text, filed=_text),
)
COMMISSION = _struct(
    _id=_text, filename=_text, country=_text, tourcodes=_texts, originating=_texts, flights=_texts, pos=_texts, from_location=_texts, to_location=_texts, pcc=_texts,
    route=_text, rbd=_text, fbc=_text, agent_discount=_text, corporate_discount=_text, discount_unit=_text, sales_period_eff_date=_text, sales_period_dis_date=_text,
    tkt_dis_date=_text, trv_dis_date=_text, rtw_fare_comm=_text, ct_fare_comm=_text,
)
FARE_RULE = _struct(fare_id=_text, whole_txt=_text, line_txt=_text, chrg_appl=IntegerType(), disc_tag1=_text, disc_tag2=_text)
TICKET = _struct(doc_nbr=_text, cpn_nbr=_text, tour_cd=_text, dep_date=DateType(), trnsc_date=DateType(), carrier=_text)
SALE = _struct(rpt_cntry_cd=_text, comm_rate=DoubleType(), eff_comm_rate=DoubleType(), tour_cd=_text)
