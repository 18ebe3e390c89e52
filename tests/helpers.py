import contextlib
import io
import math


def plan_text(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
