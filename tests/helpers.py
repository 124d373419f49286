import os
from pathlib import Path

DATA = Path(os.environ.get("CORPUS_DIR", "/root/testdata"))


def rows(df):
    """Rows as a sorted list of plain values."""

    def plain(v):
        if isinstance(v, float):
            return "null" if v != v else round(v, 6)
        if isinstance(v, (list, tuple)):
            return tuple(plain(x) for x in v)
        return v

    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=repr)
