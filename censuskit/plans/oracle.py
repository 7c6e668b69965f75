"""Oracle SQL (DuckDB dialect) for every catalogue query.

Written directly in SQL over the driver tables: the census derivation, each
rate form, each score and ranking. Conventions that keep both engines on the
same value: sums cast to BIGINT, divisions by ``nullif(x, 0)``, truncation by
``CAST(trunc(x) AS INTEGER)``, weights cast to DOUBLE, averaged doubles
rounded to 6 places, ranks cast to INTEGER.
"""

from __future__ import annotations

# Fixed values of the study, stated here apart from the library's so that a
# wrong constant there shows.
MEASURES = [
    "Functional_Electricity",
    "Solar_Panel",
    "Playground",
    "Library_or_Reading_Corner_or_Book_Bank",
    "Newspaper",
    "Kitchen_Garden",
    "Functional_Boy_Toilet",
    "Functional_Girl_Toilet",
    "Functional_Toilet_Facility",
    "Functional_Toilet_and_Urinal",
    "Functional_Drinking_Water",
    "Water_Purifier",
    "Rain_Water_Harvesting",
    "Handwash",
    "Incinerator",
    "Water_Tested",
    "WASH_Facility_Drinking_Water_Toilet_and_Handwash",
    "Ramps",
    "Medical_Checkup",
    "Complete_Medical_Checkup",
    "Internet",
    "Computer_Available",
    "Functional_Urinal_Boy",
    "Functional_Urinal_Girl",
    "Functional_Urinal",
]
SUSTAINABILITY_WEIGHTS = [
    ("Solar_Panel", 0.2),
    ("Kitchen_Garden", 0.3),
    ("Rain_Water_Harvesting", 0.4),
    ("Incinerator", 0.1),
]
HYGIENE_WEIGHTS = [
    ("Functional_Drinking_Water", 0.25),
    ("Water_Purifier", 0.25),
    ("Functional_Toilet_Facility", 0.25),
    ("Handwash", 0.15),
    ("Functional_Urinal", 0.05),
    ("Water_Tested", 0.05),
]
SECTORS = {
    "Private": [5],
    "Aided": [4],
    "Others": [3, 97, 98],
    "Government": [1, 2, 6, 8, 90, 91, 92, 93, 94, 95, 96, 101],
}
MANAGEMENT_NAMES = {
    1: "Department of Education",
    2: "Tribal Welfare Department",
    3: "Unrecognised",
    4: "Government Aided",
    5: "Private Unaided (Recognized)",
    6: "Other Govt. managed schools",
    8: "Local body",
    90: "Social welfare Department",
    91: "Ministry of Labour",
    92: "Kendriya Vidyalaya",
    93: "Jawahar Navodaya Vidyalaya",
    94: "Sainik School",
    95: "Railway School",
    96: "Central Tibetan School",
    97: "Madarsa recognized (by Wakf board/Madarsa Board)",
    98: "Madarsa unrecognized",
    101: "Other Central Govt. Schools",
}
ESSENTIALS = {
    "Functional_Drinking_Water": "Functional_Drinking_Water",
    "Functional_Boy_Toilet": "Functional_Boy_Toilet",
    "Functional_Girl_Toilet": "Functional_Girl_Toilet",
    "Handwash": "Handwash",
    "Functional_Electricity": "Functional_Electricity",
    "Functional_Newspaper": "Newspaper",
    "Library_or_Reading_Corner_or_Book_Bank": "Library_or_Reading_Corner_or_Book_Bank",
    "Playground": "Playground",
}
ADVANCED = {
    "Internet": "Internet",
    "Computer_Available": "Computer_Available",
}
DISTRICT_FEATURES = {**ESSENTIALS, **ADVANCED, "Ramps": "Ramps"}

# Academic years of the driver tables: columns of the trend tables.
PERIODS = ["2017_2018", "2018_2019", "2019_2020", "2020_2021", "2021_2022", "2022_2023", "2023_2024"]


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _s(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _measure_sql(i: int, name: str) -> str:
    return (
        f"CASE WHEN l_orderkey % {11 + i} = 0 THEN NULL ELSE CAST((l_partkey * {3 + i} + "
        f"l_suppkey * {7 + 2 * i} + l_linenumber) % (tot + 1) AS INTEGER) END AS {name}"
    )


_MGMT_NAME_CASE = (
    "CASE School_Management_Id "
    + " ".join(f"WHEN {k} THEN {_s(v)}" for k, v in MANAGEMENT_NAMES.items())
    + " END"
)

CENSUS = f"""
geo AS (
  SELECT n.n_nationkey, r.r_name AS State_Name, n.n_name AS District_Name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
base AS (
  SELECT g.State_Name, g.District_Name,
         CASE WHEN c.c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'Urban' ELSE 'Rural' END AS Location,
         CAST(CASE CAST(l.l_partkey % 6 AS INTEGER) WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 4
              WHEN 3 THEN 5 WHEN 4 THEN 92 ELSE 97 END AS INTEGER) AS School_Management_Id,
         CAST(year(o.o_orderdate) + 22 AS VARCHAR) || '_' || CAST(year(o.o_orderdate) + 23 AS VARCHAR)
           AS Academic_Year,
         CASE WHEN l.l_orderkey % 97 = 0 THEN 0 ELSE CAST(l.l_quantity AS INTEGER) END AS tot,
         l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey
),
census AS (
  SELECT State_Name, District_Name, Location,
         {_MGMT_NAME_CASE} AS School_Management_Name,
         School_Management_Id, Academic_Year, tot AS Total_Number_of_Schools,
         {(',' + chr(10) + '         ').join(_measure_sql(i, m) for i, m in enumerate(MEASURES))}
  FROM base
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([CENSUS.strip()] + [c.strip() for c in ctes]) + "\n"


def _trunc_int(expr: str) -> str:
    return f"CAST(trunc({expr}) AS INTEGER)"


def _gap_of_sums(t: str, f: str) -> str:
    return _trunc_int(f"100 * (1 - ({t} - {f}) / nullif({t}, 0))")


def _sum(col: str) -> str:
    return f"CAST(sum({col}) AS BIGINT)"


# --- row scores --------------------------------------------------------------

_T = "Total_Number_of_Schools"
SUSTAIN_ROW = " + ".join(
    f"({m} / nullif({_T}, 0)) * CAST({w} AS DOUBLE)" for m, w in SUSTAINABILITY_WEIGHTS
)
HYGIENE_ROW = (
    "(100 * ("
    + " + ".join(f"{m} * CAST({w} AS DOUBLE)" for m, w in HYGIENE_WEIGHTS)
    + f")) / nullif({_T}, 0)"
)

SUSTAIN_DISTRICTS = f"""
sd AS (
  SELECT Academic_Year, State_Name, District_Name,
         avg({SUSTAIN_ROW}) * CAST(100 AS DOUBLE) AS s
  FROM census GROUP BY Academic_Year, State_Name, District_Name
)"""

HYGIENE_DISTRICTS = f"""
hd AS (
  SELECT Academic_Year, State_Name, District_Name, avg({HYGIENE_ROW}) AS h
  FROM census GROUP BY Academic_Year, State_Name, District_Name
)"""

RURAL_COUNTS = """
rc AS (
  SELECT Academic_Year, State_Name, District_Name,
         CAST(sum(Total_Number_of_Schools) AS BIGINT) AS Rural_School_Count
  FROM census WHERE Location = 'Rural'
  GROUP BY Academic_Year, State_Name, District_Name
)"""


def _rates_sql(keys: list[str], measures: dict) -> str:
    k = ", ".join(keys)
    sums = ", ".join(f"{_sum(src)} AS s_{out}" for out, src in measures.items())
    pcts = ", ".join(f"{_gap_of_sums('t', f's_{out}')} AS {out}" for out in measures)
    return (
        f"SELECT {k}, {pcts} FROM (SELECT {k}, {_sum(_T)} AS t, {sums} "
        f"FROM census GROUP BY {k}) x"
    )


def _trend_sql(inner: str, value: str) -> str:
    cols = ", ".join(
        f"max(CASE WHEN Academic_Year = {_s(p)} THEN {value} END) AS {_q(p)}" for p in PERIODS
    )
    plist = ", ".join(_s(p) for p in PERIODS)
    return (
        f"SELECT State_Name, {cols} FROM ({inner}) v GROUP BY State_Name "
        f"HAVING count(DISTINCT CASE WHEN Academic_Year IN ({plist}) THEN Academic_Year END) = {len(PERIODS)}"
    )


OUTCOME = """
outcome AS (
  SELECT lower(trim(replace(n.n_name, 'NATION_', 'Nation '))) AS District_Name,
         CAST(year(o.o_orderdate) + 22 AS VARCHAR) AS Exam_Year,
         round(avg(o.o_totalprice) / CAST(5000 AS DOUBLE), 6) AS Pass_Pct
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2
)"""

_KEY = "lower(trim(replace(District_Name, 'NATION_', 'Nation ')))"


def _pearson(x: str, y: str) -> str:
    xs = f"CASE WHEN {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    ys = f"CASE WHEN {x} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    return f"covar_pop({xs}, {ys}) / nullif(stddev_pop({xs}) * stddev_pop({ys}), 0)"


SOME_STATES = "fs AS (SELECT * FROM fj WHERE State_Name IN ('AFRICA', 'ASIA'))"

FEATURES_JOINED = f"""
fd AS ({_rates_sql(['Academic_Year', 'State_Name', 'District_Name'], DISTRICT_FEATURES)}),
fj AS (
  SELECT fd.*, outcome.Pass_Pct FROM fd JOIN outcome
    ON lower(trim(replace(fd.District_Name, 'NATION_', 'Nation '))) = outcome.District_Name
   AND split_part(fd.Academic_Year, '_', 1) = outcome.Exam_Year
)"""

HYGIENE_JOINED = """
hj AS (
  SELECT hd.*, outcome.Pass_Pct FROM hd JOIN outcome
    ON lower(trim(replace(hd.District_Name, 'NATION_', 'Nation '))) = outcome.District_Name
   AND split_part(hd.Academic_Year, '_', 1) = outcome.Exam_Year
)"""

def _corr_long(src: str) -> str:
    return "corr_long AS (" + " UNION ALL ".join(
        f"SELECT Academic_Year, {_s(f)} AS Feature, round({_pearson(f, 'Pass_Pct')}, 6) AS Correlation "
        f"FROM {src} GROUP BY Academic_Year"
        for f in DISTRICT_FEATURES
    ) + ")"


CORR_LONG = _corr_long("fj")


def _ordinal_sql() -> str:
    p = " ".join(f"WHEN {_s(v)} THEN {i + 1}" for i, v in enumerate(PERIODS))
    f = " ".join(f"WHEN {_s(v)} THEN {i + 1}" for i, v in enumerate(DISTRICT_FEATURES))
    return f"(CASE Academic_Year {p} END) * {len(DISTRICT_FEATURES) + 1} + (CASE Feature {f} END)"


def _ramp_rows_sql() -> str:
    return (
        "SELECT Academic_Year, State_Name, "
        + _trunc_int(f"100 * (1 - {_sum(_T + ' - Ramps')} / nullif({_sum(_T)}, 0))")
        + " AS Ramp_Access_Pct FROM census GROUP BY Academic_Year, State_Name"
    )


def _hygiene_state_sql() -> str:
    return "SELECT Academic_Year, State_Name, round(avg(h), 6) AS HygieneScore FROM hd GROUP BY 1, 2"


def _sustain_state_sql() -> str:
    return "SELECT Academic_Year, State_Name, round(avg(s), 6) AS Sustainability_Score FROM sd GROUP BY 1, 2"


def _have_sql(keys: str, measure: str, name: str) -> str:
    return (
        f"SELECT {keys}, {_trunc_int(f'100 * ({_sum(measure)} / nullif({_sum(_T)}, 0))')} AS {name} "
        f"FROM census GROUP BY {keys}"
    )


def _sector_sql() -> str:
    cols = []
    for s, ids in SECTORS.items():
        idl = ", ".join(str(i) for i in ids)
        cols.append(
            f"round(avg(CASE WHEN School_Management_Id IN ({idl}) THEN m END) * CAST(100 AS DOUBLE), 6) "
            f"AS {s}_Score"
        )
    return _with(
        f"""per_id AS (
  SELECT Academic_Year, State_Name, School_Management_Id, avg({SUSTAIN_ROW}) AS m
  FROM census GROUP BY 1, 2, 3
)"""
    ) + f"SELECT Academic_Year, State_Name, {', '.join(cols)} FROM per_id GROUP BY 1, 2"


def _top(inner_cte: str, src: str, value: str, extra_order: str, n: int = 10,
         part: str = "Academic_Year") -> str:
    return _with(inner_cte) + (
        f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {part} "
        f"ORDER BY {value} DESC NULLS LAST, {extra_order}) AS INTEGER) AS Rank FROM {src}) t "
        f"WHERE Rank <= {n}"
    )


TOLERANCES = {"Functional_Boy_Toilet": 0, "Functional_Girl_Toilet": 1, "Handwash": 1, "Functional_Electricity": 2, "Playground": 3}


def _tolerances_sql() -> str:
    measures = {m: m for m in TOLERANCES}
    long = lambda src, name, keys: " UNION ALL ".join(
        f"SELECT {keys}, {_s(m)} AS Measure_Name, CAST({m} AS DOUBLE) AS {name} FROM {src}" for m in measures)
    allowed = " ".join(f"WHEN {_s(m)} THEN CAST({t} AS DOUBLE)" for m, t in TOLERANCES.items())
    return _with(
        f"yr AS ({_rates_sql(['Academic_Year', 'State_Name'], measures)})", f"al AS ({_rates_sql(['State_Name'], measures)})",
        f"o AS ({long('yr', 'Observed', 'Academic_Year, State_Name')})", f"e AS ({long('al', 'Expected', 'State_Name')})",
    ) + f"""
SELECT o.Academic_Year, o.State_Name, o.Measure_Name, Expected, Observed, CASE o.Measure_Name {allowed} END AS Tolerance,
       abs(Observed - Expected) AS Abs_Diff, coalesce(abs(Observed - Expected) <= CASE o.Measure_Name {allowed} END, false) AS Passed
FROM o JOIN e ON o.State_Name = e.State_Name AND o.Measure_Name = e.Measure_Name"""


def _box_sql(values: str = "SELECT Academic_Year, State_Name, h AS v FROM hd") -> str:
    stats = f"""
b AS ({values}),
st AS (
  SELECT Academic_Year, State_Name,
         quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3,
         min(v) AS mn, max(v) AS mx, count(v) AS n
  FROM b GROUP BY 1, 2
),
fe AS (
  SELECT *, q3 - q1 AS iqr, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lf,
         q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS uf FROM st
),
tl AS (
  SELECT b.Academic_Year, b.State_Name,
         min(CASE WHEN v >= lf AND v <= uf THEN v END) AS wl,
         max(CASE WHEN v >= lf AND v <= uf THEN v END) AS wh,
         count(CASE WHEN v IS NOT NULL AND NOT (v >= lf AND v <= uf) THEN v END) AS outl
  FROM b JOIN fe USING (Academic_Year, State_Name) GROUP BY 1, 2
)"""
    return _with(HYGIENE_DISTRICTS, stats) + """
SELECT fe.Academic_Year, fe.State_Name,
       round(q1, 6) AS Q1, round(q2, 6) AS Median, round(q3, 6) AS Q3,
       round(mn, 6) AS Min, round(mx, 6) AS Max, round(iqr, 6) AS IQR,
       round(lf, 6) AS Lower_Fence, round(uf, 6) AS Upper_Fence,
       round(wl, 6) AS Whisker_Low, round(wh, 6) AS Whisker_High,
       CAST(n AS BIGINT) AS N, CAST(outl AS BIGINT) AS Outliers
FROM fe LEFT JOIN tl USING (Academic_Year, State_Name)"""


def _quality_compare_sql() -> str:
    exp = (
        "SELECT Academic_Year, State_Name, CAST("
        + _gap_of_sums(_sum(_T), _sum("Ramps"))
        + " AS DOUBLE) AS Expected FROM census GROUP BY 1, 2"
    )
    obs = f"SELECT Academic_Year, State_Name, CAST(Ramp_Access_Pct AS DOUBLE) AS Observed FROM ({_ramp_rows_sql()}) r"
    return _with(f"e AS ({exp})", f"o AS ({obs})") + """
SELECT Academic_Year, State_Name, Expected, Observed, abs(Observed - Expected) AS Abs_Diff,
       coalesce(abs(Observed - Expected) <= CAST(0.0 AS DOUBLE), false) AS Passed
FROM e FULL OUTER JOIN o USING (Academic_Year, State_Name)"""


def oracle_sql() -> dict[str, str]:
    ess = _rates_sql(["Academic_Year", "State_Name"], ESSENTIALS)
    q: dict[str, str] = {}
    q["split"] = _with() + """
SELECT Academic_Year, State_Name,
       CAST(sum(CASE WHEN Location = 'Rural' THEN Total_Number_of_Schools END) AS BIGINT) AS Rural_School_Count,
       CAST(sum(CASE WHEN Location = 'Urban' THEN Total_Number_of_Schools END) AS BIGINT) AS Urban_School_Count,
       CAST(sum(Total_Number_of_Schools) AS BIGINT) AS School_Count
FROM census GROUP BY Academic_Year, State_Name"""
    q["split_ratio"] = f"""
SELECT *, round(Urban_School_Count / nullif(Rural_School_Count, 0), 6) AS Urban_Rural_Ratio
FROM ({q['split']}) s"""
    q["top_rural"] = _top(RURAL_COUNTS, "rc", "Rural_School_Count", "State_Name, District_Name")
    q["top_rural_per_state"] = _top(RURAL_COUNTS, "rc", "Rural_School_Count", "District_Name",
                                    n=3, part="Academic_Year, State_Name")
    q["top_private_rural"] = _top(
        """prc AS (
  SELECT Academic_Year, State_Name, District_Name,
         CAST(sum(Total_Number_of_Schools) AS BIGINT) AS Private_Rural_School_Count
  FROM census WHERE Location = 'Rural' AND School_Management_Id = 5
  GROUP BY Academic_Year, State_Name, District_Name
)""",
        "prc", "Private_Rural_School_Count", "State_Name, District_Name",
    )
    q["mgmt_mix"] = _with() + """
SELECT Academic_Year, Location, School_Management_Id, School_Management_Name,
       CAST(sum(Total_Number_of_Schools) AS BIGINT) AS School_Count
FROM census GROUP BY 1, 2, 3, 4"""
    q["mgmt_share"] = f"""
SELECT Academic_Year, Location, School_Management_Id, School_Management_Name, School_Count,
       round(sp, 6) AS Share_Pct,
       CASE WHEN sp > 2 THEN printf('%.2f', sp) ELSE '' END AS Label
FROM (SELECT *, (100 * School_Count) / nullif(sum(School_Count) OVER (PARTITION BY Academic_Year, Location), 0) AS sp
      FROM ({q['mgmt_mix']}) m) x"""
    q["state_mgmt_share"] = _with() + """
SELECT Academic_Year, State_Name, Location, School_Management_Id, School_Count, round(sp, 6) AS Share_Pct,
       CASE WHEN sp > 2 THEN printf('%.2f', sp) ELSE '' END AS Label
FROM (SELECT *, (100 * School_Count) / nullif(sum(School_Count) OVER (PARTITION BY Academic_Year), 0) AS sp
      FROM (SELECT Academic_Year, State_Name, Location, School_Management_Id,
                   CAST(sum(Total_Number_of_Schools) AS BIGINT) AS School_Count
            FROM census GROUP BY 1, 2, 3, 4) m) x"""
    q["sustain_top10"] = _top(
        SUSTAIN_DISTRICTS + ",\nsr AS (SELECT Academic_Year, State_Name, District_Name, round(s, 6) AS Sustainability_Score FROM sd)",
        "sr", "Sustainability_Score", "State_Name, District_Name",
    )
    q["sustain_state"] = _with(SUSTAIN_DISTRICTS) + _sustain_state_sql()
    q["sustain_by_mgmt"] = _with() + f"""
SELECT Academic_Year, State_Name, School_Management_Id,
       round(avg({SUSTAIN_ROW}) * CAST(100 AS DOUBLE), 6) AS Sustainability_Score
FROM census GROUP BY 1, 2, 3"""
    q["sector"] = _sector_sql()
    q["ramp"] = _with() + _ramp_rows_sql()
    q["essentials"] = _with() + ess
    q["essentials_district"] = _with() + _rates_sql(
        ["Academic_Year", "State_Name", "District_Name"], DISTRICT_FEATURES
    )
    q["adv"] = _with() + _rates_sql(["Academic_Year", "State_Name"], ADVANCED)
    q["medical_lack"] = _with() + (
        "SELECT *, 100 - No_Medical_Pct AS Medical_Pct FROM (SELECT Academic_Year, State_Name, "
        + _trunc_int(f"100 * (({_sum(_T)} - {_sum('Medical_Checkup')}) / nullif({_sum(_T)}, 0))")
        + " AS No_Medical_Pct FROM census GROUP BY 1, 2) x"
    )
    q["medical_complete_by_location"] = _with() + (
        "SELECT *, 100 - Complete_Medical_Pct AS No_Complete_Medical_Pct FROM ("
        + _have_sql("Academic_Year, Location", "Complete_Medical_Checkup", "Complete_Medical_Pct")
        + ") x"
    )
    q["medical_have"] = _with() + (
        "SELECT *, 100 - Medical_Available_Pct AS No_Medical_Available_Pct FROM ("
        + _have_sql("Academic_Year, State_Name", "Medical_Checkup", "Medical_Available_Pct")
        + ") x"
    )
    q["library_complement"] = _with() + (
        "SELECT *, 100 - Library_or_Reading_Corner_or_Book_Bank AS No_Library_Pct FROM ("
        + _rates_sql(["Academic_Year", "State_Name"], {
            "Library_or_Reading_Corner_or_Book_Bank": "Library_or_Reading_Corner_or_Book_Bank"})
        + ") x"
    )
    q["hygiene_top10"] = _top(
        HYGIENE_DISTRICTS + ",\nhr AS (SELECT Academic_Year, State_Name, District_Name, round(h, 6) AS HygieneScore FROM hd)",
        "hr", "HygieneScore", "State_Name, District_Name",
    )
    q["hygiene_district"] = _with(HYGIENE_DISTRICTS) + (
        "SELECT Academic_Year, State_Name, District_Name, round(h, 6) AS HygieneScore FROM hd"
    )
    q["hygiene_above_mean"] = _with(
        HYGIENE_DISTRICTS, "hm AS (SELECT Academic_Year, avg(h) AS m FROM hd GROUP BY 1)"
    ) + """
SELECT hd.Academic_Year, State_Name, District_Name, round(h, 6) AS HygieneScore,
       round(m, 6) AS Mean_HygieneScore
FROM hd JOIN hm ON hd.Academic_Year = hm.Academic_Year
WHERE round(h, 6) > round(m, 6)"""
    q["box"] = _box_sql()
    q["hygiene_state"] = _with(HYGIENE_DISTRICTS) + _hygiene_state_sql()
    q["trend_ramp"] = _with() + _trend_sql(_ramp_rows_sql(), "Ramp_Access_Pct")
    q["trend_internet"] = _with() + _trend_sql(
        _rates_sql(["Academic_Year", "State_Name"], ADVANCED), "Internet"
    )
    q["trend_hygiene"] = _with(HYGIENE_DISTRICTS) + _trend_sql(_hygiene_state_sql(), "HygieneScore")
    q["trend_sustain"] = _with(SUSTAIN_DISTRICTS) + _trend_sql(_sustain_state_sql(), "Sustainability_Score")
    q["trend_medical"] = _with() + _trend_sql(
        _have_sql("Academic_Year, State_Name", "Medical_Checkup", "Medical_Available_Pct"),
        "Medical_Available_Pct",
    )
    q["outcome_long"] = "WITH " + OUTCOME.strip() + "\nSELECT District_Name, Exam_Year, Pass_Pct FROM outcome"
    q["outcome_complete"] = "WITH " + OUTCOME.strip() + """
SELECT District_Name, Exam_Year, Pass_Pct FROM outcome
WHERE District_Name IN (SELECT District_Name FROM outcome GROUP BY 1 HAVING count(DISTINCT Exam_Year) = 7)"""
    q["quality_unique"] = """
SELECT 'orders' AS Check_Name, count(*) AS Keys, count(CASE WHEN n <> 1 THEN 1 END) AS Unexpected
FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey) a
UNION ALL
SELECT 'lineitem', count(*), count(CASE WHEN n <> 1 THEN 1 END)
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) b"""
    q["outcome_bad"] = "WITH " + OUTCOME.replace("lower(trim(replace(n.n_name, 'NATION_', 'Nation ')))", "replace(n.n_name, 'NATION_', 'Nation ')").strip() + """,
sheet AS (SELECT *, CAST(row_number() OVER (PARTITION BY Exam_Year ORDER BY District_Name) AS INTEGER) AS Sheet_Line FROM outcome)
SELECT Exam_Year, Sheet_Line, District_Name, 'below 50.0' AS Raw_Value FROM sheet WHERE Pass_Pct < 50"""
    q["outcome_bad_counts"] = f"SELECT Exam_Year, count(*) AS Bad_Cells FROM ({q['outcome_bad']}) b GROUP BY Exam_Year"
    q["corr_by_state"] = _with(
        "ward AS (SELECT n_name, r_name AS ws, 'Ward ' || CAST(n_nationkey // 5 AS VARCHAR) AS wn FROM nation JOIN region ON n_regionkey = r_regionkey)",
        "wc AS (SELECT census.* EXCLUDE (District_Name), wn AS District_Name FROM census JOIN ward ON census.District_Name = ward.n_name)",
        OUTCOME.replace("GROUP BY 1, 2", "GROUP BY 1, 2, n.n_name").replace("Exam_Year,", "Exam_Year, n.n_name AS nn,"),
        "wo AS (SELECT ws, wn, Exam_Year, Pass_Pct FROM outcome JOIN ward ON nn = n_name)",
        f"fd AS ({_rates_sql(['Academic_Year', 'State_Name', 'District_Name'], DISTRICT_FEATURES).replace('FROM census', 'FROM wc')})",
        "fj AS (SELECT fd.*, wo.Pass_Pct FROM fd JOIN wo ON fd.State_Name = wo.ws AND fd.District_Name = wo.wn AND split_part(fd.Academic_Year, '_', 1) = wo.Exam_Year)",
        CORR_LONG,
    ) + "SELECT * FROM corr_long"
    q["aliases_in_order"] = """
WITH RECURSIVE pairs AS (
  SELECT row_number() OVER (ORDER BY o) AS i, f, t FROM (
    SELECT n_nationkey AS o, lower(n_name) AS f, 'n' || n_nationkey || '-' AS t FROM nation
    UNION ALL SELECT 1000 + r_regionkey, 'n' || r_regionkey || '-', lower(r_name) || ' ' FROM region) x),
fold AS (
  SELECT r_name AS State_Name, n_name AS District_Name, lower(trim(n_name)) AS k, 0 AS i FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT State_Name, District_Name, replace(k, f, t), fold.i + 1 FROM fold JOIN pairs ON pairs.i = fold.i + 1)
SELECT State_Name, District_Name, k AS District_Key FROM fold WHERE i = (SELECT count(*) FROM pairs)"""
    q["ramp_zero"] = _with() + _ramp_rows_sql().replace("Total_Number_of_Schools - Ramps", "Total_Number_of_Schools - coalesce(Ramps, 0)")
    spelled = "CASE WHEN Location = 'Urban' THEN lower(State_Name) ELSE State_Name END"
    q["state_spelling"] = _with(
        f"b AS (SELECT Academic_Year, {spelled} AS State_Name, {_sum(_T)} AS Schools_Before FROM census GROUP BY 1, 2)",
        f"a AS (SELECT Academic_Year, State_Name, {_sum(_T)} AS Schools_After FROM census GROUP BY 1, 2)",
    ) + "SELECT Academic_Year, State_Name, Schools_Before, Schools_After FROM b FULL OUTER JOIN a USING (Academic_Year, State_Name)"
    q["box_rows"] = _box_sql(f"SELECT Academic_Year, State_Name, {HYGIENE_ROW} AS v FROM census")
    q["quality_tolerances"] = _tolerances_sql()
    q["quality_tolerance_counts"] = f"""
SELECT Academic_Year, Measure_Name, count(CASE WHEN Passed THEN 1 END) AS Passed_Count, count(CASE WHEN NOT Passed THEN 1 END) AS Failed_Count
FROM ({q['quality_tolerances']}) qt GROUP BY Academic_Year, Measure_Name"""
    q["corr_states"] = _with(OUTCOME, FEATURES_JOINED, SOME_STATES, _corr_long("fs")) + "SELECT * FROM corr_long"
    q["aliases"] = _with() + f"SELECT DISTINCT State_Name, District_Name, {_KEY} AS District_Key FROM census"
    q["corr"] = _with(OUTCOME, FEATURES_JOINED, CORR_LONG) + "SELECT * FROM corr_long"
    q["corr_extremes"] = _with(
        OUTCOME, FEATURES_JOINED, CORR_LONG,
        f"c AS (SELECT Feature, Academic_Year, Correlation AS v, {_ordinal_sql()} AS o "
        "FROM corr_long WHERE Correlation IS NOT NULL)",
        "mx AS (SELECT * FROM c ORDER BY v DESC, o ASC LIMIT 1)",
        "mn AS (SELECT * FROM c ORDER BY v ASC, o ASC LIMIT 1)",
    ) + """
SELECT mx.Feature AS Max_Feature, mx.Academic_Year AS Max_Academic_Year, mx.v AS Max_Correlation,
       mn.Feature AS Min_Feature, mn.Academic_Year AS Min_Academic_Year, mn.v AS Min_Correlation
FROM mx, mn"""
    q["corr_hygiene"] = _with(HYGIENE_DISTRICTS, OUTCOME, HYGIENE_JOINED) + (
        f"SELECT Academic_Year, 'HygieneScore' AS Feature, round({_pearson('h', 'Pass_Pct')}, 6) AS Correlation "
        "FROM hj GROUP BY Academic_Year"
    )

    def _fit(src: str, x: str, label: str) -> str:
        xx, yy = f"CAST({x} AS DOUBLE)", "CAST(Pass_Pct AS DOUBLE)"
        return (
            f"SELECT Academic_Year, {_s(label)} AS Feature, round(regr_slope({yy}, {xx}), 6) AS Slope, "
            f"round(regr_intercept({yy}, {xx}), 6) AS Intercept, round(regr_r2({yy}, {xx}), 6) AS R2, "
            f"CAST(regr_count({yy}, {xx}) AS BIGINT) AS N FROM {src} GROUP BY Academic_Year"
        )

    q["fit_line"] = _with(HYGIENE_DISTRICTS, OUTCOME, FEATURES_JOINED, HYGIENE_JOINED) + (
        _fit("fj", "Library_or_Reading_Corner_or_Book_Bank", "Library_or_Reading_Corner_or_Book_Bank")
        + "\nUNION ALL\n"
        + _fit("hj", "h", "HygieneScore")
    )
    q["quality_compare"] = _quality_compare_sql()
    keys = ["Academic_Year", "State_Name", "District_Name"]
    q["quality_expected"] = _with(
        "e AS (" + _have_sql(", ".join(keys), "Ramps", "x") + ")",
        "o AS (" + _have_sql(", ".join(keys), "Ramps", "y").replace("FROM census", "FROM census WHERE Location = 'Rural'") + ")",
    ) + """
SELECT Academic_Year, State_Name, District_Name, CAST(x AS DOUBLE) AS Expected, CAST(y AS DOUBLE) AS Observed,
       CAST(abs(y - x) AS DOUBLE) AS Abs_Diff, coalesce(abs(y - x) <= 1, false) AS Passed
FROM e FULL OUTER JOIN o USING (Academic_Year, State_Name, District_Name)"""
    q["quality_expected_counts"] = f"""
SELECT Academic_Year, count(CASE WHEN Passed THEN 1 END) AS Passed_Count,
       count(CASE WHEN NOT Passed THEN 1 END) AS Failed_Count
FROM ({q['quality_expected']}) qe GROUP BY Academic_Year"""
    q["quality_summary"] = f"""
SELECT Academic_Year, count(CASE WHEN Passed THEN 1 END) AS Passed_Count,
       count(CASE WHEN NOT Passed THEN 1 END) AS Failed_Count
FROM ({q['quality_compare']}) qc GROUP BY Academic_Year"""
    q["quality_spread"] = _with(RURAL_COUNTS) + """
SELECT Academic_Year, State_Name, max(Rural_School_Count) - min(Rural_School_Count) AS Spread,
       (max(Rural_School_Count) - min(Rural_School_Count)) < 3000 AS Passed
FROM rc GROUP BY 1, 2"""
    return {k: v.strip() for k, v in q.items()}
