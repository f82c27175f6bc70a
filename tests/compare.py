"""Rows of a DataFrame against rows of a DuckDB query, columns by name and rows in any order."""

DATA = "/root/testdata"


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return f"{v + 0.0:.6g}"
    return str(v)


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def sql_rows(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in cur.fetchall())
