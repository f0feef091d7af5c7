"""The tab-separated text form of a browse row:

    ip <TAB> [yyyy-MM-dd HH:mm:ss] <TAB> (androidVersion,phoneModel) <TAB> gameName <TAB> gameId
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# From the first `[`, if there is one, to the last `]`; what follows the seconds is ignored.
# Parts of the time may have one digit.
_BRACKETED_TIME = r"^(?:[^\[]*\[)?(\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}).*\]"
_WHOLE_NUMBER = r"^[+-]?[0-9]+$"


def browse_fields(fields: Column) -> dict[str, Column]:
    """Typed columns of a split line. A part that is missing or unreadable is null, never an error."""
    event_time = F.regexp_extract(F.get(fields, F.lit(1)), _BRACKETED_TIME, 1).try_cast("timestamp")
    device = F.get(fields, F.lit(2))
    parts = F.split(device, ",")
    model = F.get(parts, F.lit(1))
    # Empty parts at the end don't count as parts: `(a,` has no phone model, `(a,,b)` an empty one.
    phone_model = F.when(model != "", F.replace(model, F.lit(")"))).when(
        F.contains(F.rtrim(device, F.lit(",")), F.lit(",")), ""
    )
    digits = F.get(fields, F.lit(4))
    number = digits.try_cast("int")
    # A cast also takes blanks around a number; only numbers in unusual form need the pattern.
    game_id = F.when(number.cast("string") == digits, number).when(digits.rlike(_WHOLE_NUMBER), number)
    return {
        "ip": F.get(fields, F.lit(0)),
        "date": F.date_format(event_time, "yyyyMMddHHmm"),
        "androidVersion": F.replace(F.get(parts, F.lit(0)), F.lit("(")),
        "phoneModel": phone_model,
        "gameName": F.get(fields, F.lit(3)),
        "gameId": game_id,
        "event_time": event_time,
    }


def browse_line(has_event_time: bool) -> tuple[Column, Column]:
    """The text line of a browse row, and whether it gives the row back; seconds are `00` when only the minute is known.

    The values are tested, not the line: none may be null or hold what the format uses at its place, and the
    minute has to be that of a readable time.
    """
    date = F.col("date")
    if has_event_time:
        time_text = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")
        readable = (F.translate(F.substring(time_text, 1, 16), "-: ", "") == date) & (F.length(time_text) == 19)
    else:
        time_text = F.regexp_replace(date, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:00")
        readable = F.date_format(time_text.try_cast("timestamp"), "yyyyMMddHHmm") == date
    names = {name: F.col(name) for name in ("ip", "androidVersion", "phoneModel", "gameName")}
    used = {name: "\t\n\r" for name in names}
    used["androidVersion"] += ",("
    used["phoneModel"] += ",)"
    fits = readable & F.col("gameId").isNotNull()
    for name, column in names.items():
        for mark in used[name]:
            fits = fits & ~F.contains(column, F.lit(mark))
    line = F.concat(
        names["ip"], F.lit("\t["), time_text, F.lit("]\t("), names["androidVersion"], F.lit(","), names["phoneModel"],
        F.lit(")\t"), names["gameName"], F.lit("\t"), F.col("gameId").cast("string"),
    )
    return line, F.coalesce(fits, F.lit(False))
