from datetime import date


def month(i: int, start_year: int = 2010) -> date:
    return date(start_year + i // 12, i % 12 + 1, 1)


def rows(df, *order):
    """Rows as tuples, sorted by the given columns."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def near(got, want, tol=1e-9):
    assert len(got) == len(want), (got, want)
    for g, w in zip(got, want):
        if isinstance(w, (list, tuple)):
            near(list(g), list(w), tol)
        elif isinstance(w, float):
            assert g is not None and abs(g - w) <= tol * max(1.0, abs(w)), (got, want)
        else:
            assert g == w, (got, want)
    return True


def series(spark, values, cols="v double", key="a", start_year=2010):
    """One series ``(k, ts, v…)``; values are scalars or tuples."""
    data = [(key, month(i, start_year), *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"k string, ts date, {cols}")
