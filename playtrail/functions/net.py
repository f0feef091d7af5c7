"""Address arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ipv4_number(ip) -> Column:
    """Dotted IPv4 address as a bigint; null unless it has four parts of digits between 0 and 255."""
    parts = F.split(F.col(ip) if isinstance(ip, str) else ip, r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("int") for i in range(4)]
    # A cast would also take signs and blanks.
    valid = (F.size(parts) == 4) & F.array_join(parts, "").rlike("^[0-9]+$")
    number = F.lit(0).cast("bigint")
    for octet in octets:
        valid = valid & octet.between(0, 255)
        number = number * 256 + octet
    return F.when(valid, number)
