"""Queries of tables in HTML, tagging, codes, routes, periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import dictionary as A
from millrace.functions import extract as E
from millrace.functions import fare_tables as FT
from millrace.functions import html_tables as H
from millrace.functions import tagging as G
from millrace.plans.registry import query, table


def _values(spark, rows: str, columns: str):
    return spark.sql(f"select * from values {rows} as t({columns})")


_TABLES = """(1, '<table><tr><th colspan=2>A</th><th>B</th></tr><tr><td rowspan=2>x</td><td>1</td><td>2</td></tr><tr><td></td><td rowspan=5>3</td></tr></table>'),
 (2, '<p>Fares from USA</p><table><tr><td>o<table><tr><td>in</td></tr></table></td></tr></table><p>end</p>')"""


@query("""select * from (values (1,0,0,0,'A'),(1,0,0,1,'A'),(1,0,0,2,'B'),(1,0,1,0,'x'),(1,0,1,1,'1'),(1,0,1,2,'2'),(1,0,2,0,'x'),(1,0,2,1,''),(1,0,2,2,'3'),(2,0,0,0,'o'),(2,1,0,0,'in'))
          t(doc_id, table_no, "row", col, text)""")
def html_table_grid(spark, sf):
    return H.tables_of(spark, _values(spark, _TABLES, "doc_id, html"), "doc_id", "html")


@query("select * from (values (1,0,0,null,0),(2,0,null,'Fares from USA',0),(2,1,0,null,0),(2,2,1,null,1),(2,3,null,'end',null)) t(doc_id, ord, table_no, text, before_table)")
def html_paragraphs(spark, sf):
    rows = H.paragraphs_of(spark, _values(spark, _TABLES, "doc_id, html"), "doc_id", "html")
    return rows.withColumn("text", F.nullif("text", F.lit("")))


@query()
def html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.html_text(F.col("html")).alias("text"))


@query()
def css_color_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", H.coloured_text(F.col("html"), "#F00").alias("texts"))


_CELLS = """(1,0,0,'RBD'),(1,0,1,'FARE BASIS'),(1,0,2,'ROUTE'),(1,0,3,'CORPORATE DISCOUNT'),(1,0,4,'AGENT DISCOUNT'),
 (1,1,0,'J/C'),(1,1,1,'JX1'),(1,1,2,'DFW - HKG'),(1,1,3,'3%'),(1,1,4,'10%'),(1,2,0,'Y'),(1,2,1,'YX2'),(1,2,2,'DFW - HKG'),(1,2,3,'0%'),(1,2,4,'7%'),
 (1,3,0,'M'),(1,3,1,'MX3'),(1,3,2,'FIRST CLASS'),(1,3,3,'0%'),(1,3,4,'5%'),(2,0,0,'NAME'),(2,0,1,'DISCOUNT'),(2,1,0,'x'),(2,1,1,'4%')"""


@query("""select * from (values (1,'RBD',0),(1,'FBC',1),(1,'CORPORATE_DISCOUNT',3),(1,'AGENT_DISCOUNT',4),(1,'ROUTE',2),(2,'AGENT_DISCOUNT',1)) t(table_no, tag, col)""")
def header_roles(spark, sf):
    return FT.header_roles(_values(spark, _CELLS, 'table_no, row, col, text'), ["table_no"])


@query("""select * from (values (1,1,'J','JX1',10,3,'P','DFW - HKG',['DFW'],['HKG']),(1,1,'C','JX1',10,3,'P','DFW - HKG',['DFW'],['HKG']),(1,2,'Y','YX2',7,0,'P','DFW - HKG',['DFW'],['HKG']))
          t(table_no, "row", rbd, fbc, agent_discount, corporate_discount, discount_unit, route, from_location, to_location)""")
def fare_table_rows(spark, sf):
    return FT.fare_rows(_values(spark, _CELLS, 'table_no, row, col, text'), ["table_no"])


@query("select * from (values (1,0,0,'A B'),(1,0,1,'x 1 2'),(1,0,2,'x 3'),(2,0,0,'o'),(2,1,0,'in')) t(doc_id, table_no, \"row\", text)")
def table_row_texts(spark, sf):
    return FT.row_texts(H.tables_of(spark, _values(spark, _TABLES, "doc_id, html"), "doc_id", "html"), ["doc_id", "table_no"])


@query("select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title from pages")
def page_titles(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.regexp_extract("html", "(?i)<title>([^<]*)</title>", 1).alias("title"))


@query("select * from (values ('HKG','city'),('JFK','airport'),('US','country'),('ASIA','region'),('XXX','code')) t(place, kind)")
def route_kinds_by_table(spark, sf):
    places = _values(spark, "('HKG'),('JFK'),('US'),('ASIA'),('XXX'),('HKG')", "place")
    return E.place_kinds(places, _values(spark, "('HKG','HKG','HK'),('JFK','NYC','US'),('NYC','NYC','US')", "code, city, country"))


@query("select * from (values (1,0,false,'A',false),(1,1,true,'A',true),(1,2,false,'B',false),(1,3,true,'B',false),(1,4,false,'B',true)) t(doc_id, table_no, follows, header, carried)")
def carried_headers(spark, sf):
    """A second table of another colour right after the first takes its header; one of the same colour keeps its own; one without a header takes the last."""
    html = "<table bgcolor=red><tr><td>A</td></tr></table> <table><tr><td>x</td></tr></table><p>t</p><table><tr><td>B</td></tr></table><table><tr><td>B</td></tr></table><p>u</p><table></table>"
    marks = H.paragraphs_of(spark, spark.createDataFrame([(1, html)], "doc_id int, html string"), "doc_id", "html")
    facts = spark.createDataFrame([(1, 0, "A", "red"), (1, 1, "x", "blue"), (1, 2, "B", "blue"), (1, 3, "B", "blue"), (1, 4, None, "blue")], "doc_id int, table_no int, header string, bgcolor string")
    tables = facts.join(FT.back_to_back(marks.select("doc_id", "ord", "table_no", F.coalesce("text", F.lit("")).alias("text")), "doc_id"), ["doc_id", "table_no"])
    return FT.carry_headers(tables, "doc_id").select("doc_id", "table_no", "follows", "header", "carried")


@query("select * from (values ('LAX - HKG', '2017-12-31', '2018-01-31'), ('LAX - HKG travel until 30Nov17', '2017-12-31', '2017-11-30'), ('ORD - HKG tkt till 01Oct17', '2017-10-01', '2018-01-31')) t(route, sales_to, travel_to)")
def route_overrides(spark, sf):
    rows = spark.createDataFrame([("LAX - HKG",), ("LAX - HKG travel until 30Nov17",), ("ORD - HKG tkt till 01Oct17",)], "route string")
    return FT.row_periods(rows.withColumn("sales_to", F.lit("2017-12-31")).withColumn("travel_to", F.lit("2018-01-31")))


_CODED = "(1,0,0,'TOUR CODE'),(1,0,1,'NOTE'),(1,1,0,'A1FF6'),(1,1,1,'B1FF6'),(1,2,0,'BASE'),(1,3,0,'C1FF6'),(1,4,0,'D1FF6')"


@query("select * from (values (1,1,0,'A1FF6'),(1,4,0,'D1FF6')) t(table_no, \"row\", col, code)")
def column_under_header(spark, sf):
    return FT.codes_under_header(_values(spark, _CODED, "table_no, row, col, text"), ["table_no"], "CODE", E.TOUR_CODE)


_STREAMS = """(1, 'see HKG2407FF538 and HKG2407FF538 now'),(2, 'ADHOC code TYO4102 FF800 here'),(3, 'x LON23 FF 501 y'),(4, 'OKA4601FF801/701/702 z'),(5, 'AB1FF516 only'),(6, 'none')"""


@query("""select * from (values (1,'HKG2407FF538',2,false),(2,'TYO4102FF800',1,true),(3,'LON23FF501',1,false),(4,'OKA4601FF801',1,false),(4,'OKA4601FF701',1,false),(4,'OKA4601FF702',1,false),(5,'AB1FF516',1,true))
          t(doc_id, code, n, adhoc)""")
def tourcode_extract(spark, sf):
    rows = _values(spark, _STREAMS, "doc_id, text").select("doc_id", F.split("text", " ").alias("words"))
    return E.tour_codes(rows, "doc_id", "words")


@query("""with r as (select * from (values ('OKA4601FF801/701'),('X1FF800/700/600'),('NONE')) t(text)), p as (select text, string_split(regexp_extract(text, '[A-Z0-9]+FF[0-9]+(?:/[0-9]+)+'), '/') as p from r where regexp_matches(text, 'FF[0-9]+/'))
          select text, list_concat([p[1]], list_transform(p[2:], lambda x: p[1][:-4] || x)) as codes from p""")
def range_expand(spark, sf):
    rows = _values(spark, "('OKA4601FF801/701'),('X1FF800/700/600'),('NONE')", "text").select("text", F.array("text").alias("words")).where(F.col("text").rlike("FF[0-9]+/"))
    return E.tour_codes(rows, "text", "words").groupBy("text").agg(F.array_sort(F.collect_list("code"), lambda x, y: F.when(x > y, -1).otherwise(1)).alias("codes"))


# fixed values: routes with the places on both sides
_ROUTES = (
    ("DFW – HKG", ["DFW"], ["HKG"]), ("ORD-HKG", ["ORD"], ["HKG"]), ("USA OR MEXICO - ASIA", ["USA", "MEXICO"], ["ASIA"]), ("CANADA TO", ["CANADA"], None), ("TOWUH, CAN, BJS,", None, ["WUH", "CAN", "BJS"]),
    ("SHA OR HKG", ["SHA", "HKG"], ["SHA", "HKG"]), ("ALL CX AND KA", ["ALL CX AND KA"], ["ALL CX AND KA"]), ("LAX TO ASIA ONLY", ["LAX"], ["ASIA"]), ("LAX TO ASIA", ["LAX"], ["ASIA"]),
    ("BOS TO PVG", ["BOS"], ["PVG"]), ("CANADA TO ASIA", ["CANADA"], ["ASIA"]), ("CHI OR CID TO ASIA", ["CHI", "CID"], ["ASIA"]), ("USA-AISA", ["USA"], ["ASIA"]), ("BOS SIN AND BOS SHA", ["BOS"], ["SIN", "SHA"]),
    ("JFK/EWR-AISA", ["JFK", "EWR"], ["ASIA"]), ("USA ORLATIN AMERICA - ASIA", ["USA", "LATIN AMERICA"], ["ASIA"]), ("USA OR LATIN AMERICA - ASIA", ["USA", "LATIN AMERICA"], ["ASIA"]), ("USA ASIA", ["USA"], ["ASIA"]),
    ("CANADA – ASIA*", ["CANADA"], ["ASIA"]), ("TOKYO TO HONG KONG", ["TOKYO"], ["HONG KONG"]), ("MEXICO ANDLATIN AMERICA", ["MEXICO", "LATIN AMERICA"], ["MEXICO", "LATIN AMERICA"]),
    ("MEXICO AND LATIN AMERICA", ["MEXICO", "LATIN AMERICA"], ["MEXICO", "LATIN AMERICA"]), ("WUH, CAN, BJS, SHA OR HKG", ["WUH", "CAN", "BJS", "SHA", "HKG"], ["WUH", "CAN", "BJS", "SHA", "HKG"]),
)


@query("select * from (values " + ", ".join("('{}', {}, {})".format(r, *("null" if x is None else x for x in (a, b))) for r, a, b in _ROUTES) + ") t(route, from_location, to_location)")
def route_split(spark, sf):
    rows = spark.createDataFrame([(r,) for r, _, _ in _ROUTES], "route string")
    return rows.select("route", E.route_ends(F.col("route")).alias("r")).select("route", "r.*")


_ORIGINS = "('Originating OTHER THAN USA/MEX/LATIN AMERICA'),('Originating from USA UPFRONT DISCOUNT'),('USA/MEXICO and LATIN AMERICA UPFRONT COMMISSION'),('valid for USA /MEXICO / LATIN AMERICA originating traffic'),('Originating from DFW on CX CODE SHARE')"


@query("""select * from (values ('Originating OTHER THAN USA/MEX/LATIN AMERICA',['-US','-MX','-LATIN AMERICA']),('Originating from USA UPFRONT DISCOUNT',['+US']),('USA/MEXICO and LATIN AMERICA UPFRONT COMMISSION',[]),
   ('valid for USA /MEXICO / LATIN AMERICA originating traffic',['+US','+MX','+LATIN AMERICA']),('Originating from DFW on CX CODE SHARE',['+DFW'])) t(text, origins)""")
def signed_origins(spark, sf):
    return _values(spark, _ORIGINS, "text").select("text", E.origins_of(F.col("text")).alias("origins"))


# fixed values: sentences with the day until which a previous version holds
_DEADLINES = (
    ("Previous version V2017-006 dated 28/09/2017 will be honoured for ticket issue on/before 10Oct17", "2017-10-10"),
    ("Previous version valid for sales upto 31Dec17", "2017-12-31"),
    ("Previous version V2017-005 (26/07/2017) will be honour for tkt iss up to 16Aug17.", "2017-08-16"),
    ("Fare & class code revised and extended for sales till 31Dec16. Previous vers V2015-003 will honoured for tkt issued upto 05Mar16.", "2016-03-05"),
    ("All bookings made on previous version LON2300FF500 to be issued as per normal ticketing time limit or by latest 02 April 2017", "2017-04-02"),
    ("Bookings made under the previous version LON6062FF880 must be issued by 31May 16", "2016-05-31"),
    ("Fares extended for sales till 26Apr17", None),
    ("Wef 01May17, fares / validity revised and extended till 30Apr18.", None),
    ("上 一 版 本 V1703 宽 限 期 延 至 2017-09-08 最 后 更 新 日 期 ：2017-09-01", "2017-09-08"),
    ("上 一 版 本 V1703 开 票 宽 限 期 为 2017-05-12 最 后 更 新 日 期 ：2017-05-05", "2017-05-12"),
    ("上 一 版 本 V1707 开 票 宽 限 期 至 ： 2017 年 12 月 9 日 最 后 更 新 日 期 ：2017-12-05", "2017-12-09"),
    ("FOC9501FF701&FOC9501FF708 V1702 开 票 宽 限 期 至 ：2017-11-23 最 后 更 新 日 期 ：2017-11-16", "2017-11-23"),
    ("上 一 版 本 TAO9300FF700 V1703 最 后 开 票 日 期 到 2017-11-23 。 最 后 更 新 日 期 ：2017-11-16", "2017-11-23"),
    ("上 一 版 本 V1711 开 票 宽 限 期 至 : 10/16/2017 2017-10-09", "2017-10-16"),
    ("上 一 版 本 V1704 开 票 宽 限 期 2017-08-02 2017-07-26", "2017-08-02"),
    ("Previous version valid till 05May17 and on request till 03May17", "2017-05-03"),
)


@query("select text, day::date as day from (values " + ", ".join("('{}', {})".format(t, f"'{d}'" if d else "null") for t, d in _DEADLINES) + ") t(text, day)")
def extension_dates(spark, sf):
    rows = spark.createDataFrame([(t,) for t, _ in _DEADLINES], "text string")
    return rows.select("text", E.extension_date_of(F.col("text")).alias("day"))


@query("select * from (values (1,'2017-05-19','2017-10-28'),(2,'2017-01-01','2017-02-01'),(3,'2016-01-01','9999-12-31')) t(id, \"from\", \"to\")")
def period_priority(spark, sf):
    rows = _values(spark, "(1,'none','HKM0816_FOC_Prom_17003_dep_19May17 - 28Oct17(20170519).html'),(2,'travel from 01Jan17 to 01Feb17','x'),(3,'',null)", "id, body, filename")
    both = rows.select("id", E.periods_of(F.col("body"), "travel").alias("b"), E.periods_of(F.col("filename"), "travel").alias("f"))
    return both.select("id", F.explode(E.choose_periods(F.col("b"), F.col("f"))).alias("p")).select("id", "p.*")


# fixed values: sentences with their outermost chunks
_CHUNKS = (
    ("PREVIOUS VERSION VALID FOR SALES UPTO 31Dec17 ONLY", [("PREVIOUS VERSION VALID FOR SALES UPTO 31Dec17", "EXTENSION_DATE")]),
    ("x SALES 30MAR2017 26APR2017", [("SALES 30MAR2017 26APR2017", "SALESPERIOD")]),
    ("take CX 7681", [("CX 7681", "FLIGHT")]),
    ("valid from 1 January 2018 onwards", [("valid from 1 January 2018", "VALIDITYPERIOD")]),
    ("travel until 30Nov17", [("travel until 30Nov17", "TRAVELPERIOD")]),
    ("originating other than USA / MEXICO and CANADA", [("originating other than USA / MEXICO and CANADA", "ORIGINS_EXCLUDED")]),
    ("USA / MEXICO originating traffic", [("USA / MEXICO originating", "ORIGINS")]),
    ("HKG24FF501 for HKG", [("HKG24FF501 for HKG", "TOURCODELOCATION")]),
    ("LAX or SFO to HKG", [("LAX or SFO to HKG", "ROUTEPAIR")]),
    ("10% agent commission", [("10% agent commission", "RATE")]),
    ("excluding KA 902 / 903", [("excluding KA 902 / 903", "FLIGHTS_EXCLUDED")]),
    ("CX / KA business class fares at HKD100", [("CX / KA", "CARRIERS"), ("business class fares", "FARES"), ("HKD100", "AMOUNT")]),
    ("nothing here", []),
)


@query("select * from (values " + ", ".join(f"({i}, '{w}', '{label}')" for i, (_, found) in enumerate(_CHUNKS) for w, label in found) + ") t(id, words, label)")
def span_query(spark, sf):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(_CHUNKS)], "id int, text string").select("id", F.split("text", " ").alias("w"))
    spans = rows.withColumn("s", F.explode(F.filter(G.spans_of(F.col("w"), G.tables_of(LOCATION=["SFO"])), lambda s: s["depth"] == 0)))
    return spans.select("id", F.array_join(F.slice("w", F.col("s.start") + 1, F.col("s.stop") - F.col("s.start")), " ").alias("words"), F.col("s.label").alias("label"))


@query()
def tag_documents(spark, sf):
    return table(spark, sf, "documents").where("lang = 'en'").select("doc_id", G.tags_of(F.col("text")).alias("tags"))


@query("select * from (values (1, '汉语'), (2, '发展中国'), (3, null), (4, 'Qc汉'), (5, 'xYZ')) t(id, simplified)")
def trad_to_simp(spark, sf):
    from millrace.functions.dictionary import convert

    rows = _values(spark, "(1,'漢語'),(2,'發展中國'),(3,null),(4,'abc漢'),(5,'abcd')", "id, text")
    return rows.select("id", convert(F.col("text"), {"漢語": "汉语", "發展": "发展", "漢": "汉", "國": "国", "ab": "Q", "a": "x", "bcd": "YZ"}).alias("simplified"))


_COMMISSIONS = """('a', array('X1FF6', 'X2FF7'), array('+US'), cast(null as array<string>), array('US'), array('USA'), array('ASIA'), array(), '', 'J', '10 %', '3%', '2017-01-01', '', '9999', '5'),
 ('b', array("'X3FF8'"), array(), array('+CX1'), array(), array(), array(), cast(null as array<string>), 'SHA OR HKG', 'Y', '7', '', '2017-02-01', '2017-03-01', '', ''),
 ('c', array('X4'), array(), array(), array('US'), array('OR'), array('HKG'), array(), '', 'M', '1%', '', '', '', '', ''),
 ('d', array('X5'), array(), array(), array('US'), array('SYSTEM'), array('HKG'), array(), '', 'M', '1%', '', '2017-13-01', '', '', '')"""


@query("""select * from (values ('a','X1FF6',10.0::double,'USA','ASIA','US'),('a','X2FF7',10.0,'USA','ASIA','US'),('b','X3FF8',7.0,'SHA','SHA',''),('b','X3FF8',7.0,'SHA','HKG',''),('b','X3FF8',7.0,'HKG','SHA',''),('b','X3FF8',7.0,'HKG','HKG',''))
          t(_id, tourcodes, agent_discount, from_location, to_location, pos)""")
def commission_star(spark, sf):
    from millrace.operators.commission_etl import star

    names = "_id, tourcodes, originating, flights, pos, from_location, to_location, pcc, route, rbd, agent_discount, corporate_discount, sales_period_eff_date, sales_period_dis_date, rtw_fare_comm, ct_fare_comm"
    rows = _values(spark, _COMMISSIONS, names).withColumn("tkt_dis_date", F.lit("")).withColumn("trv_dis_date", F.lit(""))
    airports = _values(spark, "('HKG','HK','HKG','310'),('SHA','CN','SHA','320')", "code, country, city, zone")
    made = star(rows, airports, 4)
    return made.commissions.join(made.locations, "loc_fk").select("_id", "tourcodes", "agent_discount", "from_location", "to_location", "pos")


_SHEET = """<p>INCENTIVE AGREEMENT. Originating from USA. Sales from 01Jan17 to 31Mar17</p><table><tr><th>RBD</th><th>FARE BASIS</th><th>ROUTE</th><th>AGENT DISCOUNT</th></tr>
<tr><td>J/C</td><td>JX</td><td>LAX - HKG</td><td>10%</td></tr><tr><td>Y</td><td>YX</td><td></td><td>5%</td></tr></table><p>RTW fares: no commission. travel from 01Feb17 to 30Apr17</p>"""


@query("""select * from (values (1,'J',10,['LAX'],['HKG'],['+US'],'2017-01-01','2017-03-31',0,9999,'2017-04-30'),(1,'C',10,['LAX'],['HKG'],['+US'],'2017-01-01','2017-03-31',0,9999,'2017-04-30'),
   (1,'Y',5,['LAX'],['HKG'],['+US'],'2017-01-01','2017-03-31',0,9999,'2017-04-30')) t(doc_id, rbd, agent_discount, from_location, to_location, originating, sales_from, sales_to, rtw_fare_comm, ct_fare_comm, trv_dis_date)""")
def commission_sheet_rows(spark, sf):
    from millrace.operators.sheets import commission_rows, selected

    docs = spark.createDataFrame([(1, "US", _SHEET), (2, "US", "<p>other</p>"), (3, "HK", _SHEET)], "doc_id int, country string, html string")
    rows = commission_rows(selected(docs, "incentive agreement", "US"))
    return rows.select("doc_id", "rbd", "agent_discount", "from_location", "to_location", "originating", "sales_from", "sales_to", "rtw_fare_comm", "ct_fare_comm", "trv_dis_date")


@query("select * from (values (1, date '2017-10-10', date '2017-09-20', 20), (2, date '2017-10-10', date '2017-10-01', 9)) t(doc_id, extension_date, effective_date, days)")
def extension_records(spark, sf):
    from millrace.operators.sheets import extension_records as records

    rows = "(1,'sales from 20Sep17 Previous version valid upto 10Oct17','iss_01Sep17.html'),(2,'Previous version valid upto 10Oct17','iss_01Oct17.html'),(3,'nothing','x'),(4,null,null)"
    return records(_values(spark, rows, "doc_id, text, filename"))


@query("select * from (values ('USA','country'),('ASIA','region'),('HKG','code'),('NORTH POLE','name'),('',null)) t(place, kind)")
def route_kinds(spark, sf):
    return _values(spark, "('USA'),('ASIA'),('HKG'),('NORTH POLE'),('')", "place").select("place", E.place_kind(F.col("place")).alias("kind"))


@query("select * from (values ('VIA CX888/889','+CX888'),('VIA CX888/889','+CX889'),('+CX1','+CX1')) t(text, flight)")
def flight_pairs(spark, sf):
    return _values(spark, "('VIA CX888/889'),('+CX1')", "text").select("text", F.explode(E.unpack_pair(F.col("text"))).alias("flight"))


@query("select doc_id, case when quality = 1 then 'no' when quality = 0 then 'yes' end as label from labels")
def label_recode(spark, sf):
    from millrace.operators.nested import recode_labels

    kind = F.when(F.col("quality") == 1, "paper").when(F.col("quality") == 0, "filed")
    return table(spark, sf, "labels").select("doc_id", recode_labels(kind, {"paper": "no", "filed": "yes"}).alias("label"))


@query("select doc_id, case when lang = 'en' then ['lang', 'long'] else ['lang'] end as keys from documents")
def feature_keys(spark, sf):
    from millrace.operators.nested import all_keys

    base = F.create_map(F.lit("lang"), F.col("lang"))
    more = F.when(F.col("lang") == "en", F.create_map(F.lit("long"), F.lit("x")))
    return table(spark, sf, "documents").select("doc_id", all_keys(base, more).alias("keys"))


# --- dictionaries over whole texts


@query("""with v as (select distinct unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as word from benchmark),
   p as (select doc_id, lower(text) as t from documents where text is not null)
   select doc_id, count(*) as words, max(length(word)) as longest, count(*) filter (regexp_matches(t, '\\b' || word || '\\b')) as whole_words from p join v on contains(t, word) group by doc_id""")
def dictionary_words(spark, sf):
    """How many of the benchmark's words are in each document, the longest of them, and how many stand there as words of their own."""
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    docs = table(spark, sf, "documents").where("text is not null").select("doc_id", F.lower("text").alias("text"))
    found = A.occurrences(docs, "doc_id", "text", words)
    own = docs.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[0-9a-z_]+"), F.lit(0)))).alias("word")).withColumn("whole", F.lit(1))
    joined = found.join(own, ["doc_id", "word"], "left")
    return joined.groupBy("doc_id").agg(F.count("*").alias("words"), F.max(F.length("word")).cast("long").alias("longest"), F.count("whole").alias("whole_words"))
