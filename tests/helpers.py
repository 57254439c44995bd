import datetime as dt
import decimal
import hashlib

import duckdb

from strata.sources.testdata import TABLES


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def multiset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in rows)


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def same_as_oracle(spark_df, con, sql):
    cols, rows = spark_df.columns, [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols), (cols, ocols)
    assert len(rows) == len(orows), (len(rows), len(orows))
    a, b = multiset(cols, rows), multiset(ocols, orows)
    if a != b:
        sa, sb = set(a), set(b)
        raise AssertionError(f"value mismatch; spark-only {list(sa - sb)[:3]} oracle-only {list(sb - sa)[:3]}")
    return hashlib.sha1("\n".join(a).encode()).hexdigest()


def stored_bronze(spark, df):
    """The frame as a stored bronze table, whose row ids are fixed."""
    import uuid

    from strata.session import checkpoint_root
    from strata.sources.bronze import read_bronze, write_bronze

    path = f"{checkpoint_root(spark)}/tests/{uuid.uuid4().hex}"
    write_bronze(df, path)
    return read_bronze(spark, path)
