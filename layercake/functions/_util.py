from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


# The space characters that `trim` takes off both ends (tabs and line
# ends stay).
SPACES = " \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000"


def trim_spaces(c: ColumnOrName) -> Column:
    return F.btrim(col(c), F.lit(SPACES))


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lit_or_col(v: object) -> Column:
    return v if isinstance(v, Column) else F.lit(v)
