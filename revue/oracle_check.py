"""Side-by-side check of a Spark query against its DuckDB oracle (as the driver does)."""

from __future__ import annotations

import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "float": "FLOAT", "boolean": "BOOLEAN", "smallint": "SMALLINT", "date": "DATE"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from revue.plans.catalog import ORACLE, QUERIES
    con = con or duck(sf_dir)
    t0 = time.time()
    sq = QUERIES[name](spark, sf_dir)
    spark_df_types = sq.dtypes
    sdf = sq.toPandas()
    t1 = time.time()
    res = {"query": name, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["oracle"] = "none"
        return res
    ddf = con.execute(ORACLE[name]).df()
    dtypes = {r[0]: r[1] for r in con.execute(f"describe {ORACLE[name]}").fetchall()}
    stypes = dict(spark_df_types)
    bad = {c: (stypes.get(c), dtypes.get(c)) for c in set(stypes) | set(dtypes)
           if SPARK_TO_DUCK.get(stypes.get(c), stypes.get(c)) != dtypes.get(c)}
    res["types_match"] = not bad
    if bad:
        res["type_diff"] = bad
    res["oracle_rows"] = len(ddf)
    sc, sr = rows_of(sdf.astype(object).where(sdf.notna(), None))
    dc, dr = rows_of(ddf.astype(object).where(ddf.notna(), None))
    res["columns_match"] = sc == dc
    res["values_match"] = sr == dr
    if not res["values_match"] and sc == dc:
        ss, ds = set(sr), set(dr)
        res["only_spark"] = list(ss - ds)[:3]
        res["only_oracle"] = list(ds - ss)[:3]
    if sc != dc:
        res["cols"] = (sc, dc)
    return res


def main(argv: list[str]) -> None:
    from revue.conf import local_session
    from revue.plans.catalog import QUERIES
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = local_session()
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and go on
            r = {"query": n, "error": repr(e)[:400]}
        ok = (r.get("values_match", r.get("oracle") == "none") and r.get("types_match", True)
              and "error" not in r)
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv)
