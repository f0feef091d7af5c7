"""Row keys of the keyed browse table."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(date="date", ip="ip", game_id="gameId") -> Column:
    """`date_crc32(ip + gameId)`, the checksum in unsigned decimal.

    The date comes first so that keys sort by time. Two rows can share this key (the parts are joined
    without a separator, and checksums collide), so rows are told apart by the real columns.
    """
    return F.concat(
        _col(date), F.lit("_"), F.crc32(F.concat(_col(ip), _col(game_id).cast("string"))).cast("string")
    )


def exact_row_key(date="date", ip="ip", game_id="gameId") -> Column:
    """`row_key` followed by the address and the game, hence unique per (date, ip, gameId)."""
    return F.concat_ws("_", row_key(date, ip, game_id), _col(ip), _col(game_id).cast("string"))


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
