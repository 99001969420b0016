"""Property tests (hypothesis) against brute-force Python versions of the reference's formulas.

Each example is evaluated as one small Spark job; examples are few but
generated adversarially (empty codes, NULL codes, ties at the limit).
"""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerweave.functions.columns import lpad_zero, transaction_code
from ledgerweave.operators import balance

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def brute_groups(counts: dict, limit: int, width: int) -> dict:
    """DENSE_RANK over large codes; n_large + floor((running - 1) / width) + 1 over the small ones."""
    order = sorted(counts, key=lambda c: (c is not None, c or ""))      # NULL first
    large = [c for c in order if counts[c] > limit]
    out = {c: i + 1 for i, c in enumerate(large)}
    running = 0
    for c in order:
        if counts[c] <= limit:
            running += counts[c]
            out[c] = len(large) + math.floor((running - 1) / width) + 1
    return out


codes = st.one_of(st.none(), st.text(alphabet="0129AK", min_size=0, max_size=6))


@SETTINGS
@given(st.dictionaries(codes, st.integers(min_value=1, max_value=20), min_size=1, max_size=40),
       st.integers(min_value=1, max_value=15), st.integers(min_value=1, max_value=30),
       st.sampled_from([None, 1, 2, 4, (1, 3), (2, 4, 5)]))
def test_groups_match_brute_force(spark, counts, limit, width, bucket_len):
    df = spark.createDataFrame([("d", c, n) for c, n in counts.items()],
                               "periodo string, code string, total_registros long")
    got = {r["code"]: r["grupo_salida"] for r in
           balance.assign_groups(df, ["periodo"], "code", limit, bucket_len, width).collect()}
    assert got == brute_groups(counts, limit, width)


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=-99999, max_value=10 ** 7), st.integers(min_value=1, max_value=6)),
                min_size=1, max_size=30))
def test_lpad_pads_and_truncates(spark, values):
    df = spark.createDataFrame(values, "v long, w int")
    got = [r[0] for r in df.select(F.expr("lpad(CAST(v AS STRING), w, '0')")).collect()]
    want = [(str(v)[:w] if len(str(v)) >= w else "0" * (w - len(str(v))) + str(v)) for v, w in values]
    assert got == want
    fixed = [r[0] for r in df.select(lpad_zero("v", 4)).collect()]
    assert fixed == [(str(v)[:4] if len(str(v)) >= 4 else str(v).rjust(4, "0")) for v, _ in values]


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31))),
                          st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)),
                          st.one_of(st.none(), st.integers(min_value=0, max_value=10 ** 6)),
                          st.integers(min_value=1, max_value=12)), min_size=1, max_size=20))
def test_transaction_code(spark, rows):
    df = spark.createDataFrame(rows, "e date, p date, s long, r long")
    got = [x[0] for x in df.select(transaction_code("AK", "e", "p", "s", "r")).collect()]

    def pad(v, w):
        t = str(v)
        return t[:w] if len(t) >= w else t.rjust(w, "0")

    want = [None if e is None or s is None else
            "AK" + e.strftime("%Y%m%d") + p.strftime("%Y%m%d") + pad(s, 4) + pad(r, 1)
            for e, p, s, r in rows]
    assert got == want


def brute_file_name(template, date_text, rows, counter, total, rerun, ext):
    ext = ext or "txt"
    name = template
    for k, v in [("{FECHA_INICIAL}", date_text), ("{FECHA_FINAL}", date_text), ("{{FORMATO_FECHA}}", date_text),
                 ("{FORMATO_FECHA}", date_text), ("{CANTIDAD_REGISTROS}", str(rows)), ("{CONTADOR}", str(counter)),
                 ("{TOTAL_ARCHIVOS}", str(total)), ("{VAR_REPROCESO}", str(rerun)), ("{EXTENCION}", ext)]:
        name = name.replace(k, v)
    if "{VAR_REPROCESO}" not in template and name.endswith(f"_1.{ext}"):
        name = name[: -len(f"_1.{ext}")] + f"_{rerun}.{ext}"
    return name.replace(" ", "_").replace("/", "_")


parts = st.sampled_from(["{FECHA_INICIAL}", "{FECHA_FINAL}", "{{FORMATO_FECHA}}", "{FORMATO_FECHA}",
                         "{CANTIDAD_REGISTROS}", "{CONTADOR}", "{TOTAL_ARCHIVOS}", "{VAR_REPROCESO}",
                         "{EXTENCION}", "_", "_1", ".", " ", "/", "X", "de", "_1.txt", "_1.csv"])


@SETTINGS
@given(st.lists(st.tuples(st.lists(parts, min_size=1, max_size=8).map("".join),
                          st.integers(min_value=0, max_value=999), st.integers(min_value=1, max_value=99),
                          st.integers(min_value=1, max_value=99), st.integers(min_value=1, max_value=12),
                          st.sampled_from([None, "txt", "csv"])), min_size=1, max_size=25))
def test_file_names_match_brute_force(spark, cases):
    from ledgerweave.functions.filenames import file_name
    df = spark.createDataFrame([(t, r, c, tot, rr, e) for t, r, c, tot, rr, e in cases],
                               "t string, r long, c long, tot long, rr long, e string")
    got = [x[0] for x in df.select(file_name(F.col("t"), F.lit("20240105"), F.col("r"), F.col("c"), F.col("tot"),
                                             F.col("rr"), F.col("e"))).collect()]
    assert got == [brute_file_name(t, "20240105", r, c, tot, rr, e) for t, r, c, tot, rr, e in cases]
