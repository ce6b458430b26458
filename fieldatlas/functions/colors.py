"""Colours as arithmetic on ids and ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Golden-ratio step, saturation and brightness of the palette.
HUE_STEP = 0.6180339887498949
SATURATION = 0.62
BRIGHTNESS = 0.85
# Greys for missing colours.
GREY = "#d3d3d3"
CHART_GREY = "#bfbfbf"
# Lightness range of a sub-cluster ramp.
RAMP_LOW, RAMP_HIGH = 0.30, 0.70


def _hex(red: Column, green: Column, blue: Column) -> Column:
    return F.lower(F.concat(F.lit("#"), *[F.lpad(F.hex(c.cast("bigint")), 2, "0")
                                          for c in (red, green, blue)]))


def stable_color(cluster: Column) -> Column:
    """Hue stepped by the golden ratio: the same id always gets the same colour."""
    hue = (cluster.cast("double") * F.lit(HUE_STEP)) % F.lit(1.0)
    sector = F.floor(hue * 6.0)
    part = hue * 6.0 - sector
    high, low = F.lit(BRIGHTNESS), F.lit(BRIGHTNESS * (1.0 - SATURATION))
    falling = F.lit(BRIGHTNESS) * (1.0 - F.lit(SATURATION) * part)
    rising = F.lit(BRIGHTNESS) * (1.0 - F.lit(SATURATION) * (1.0 - part))
    # red, green, blue for each sixth of the colour wheel
    wheel = [(high, rising, low), (falling, high, low), (low, high, rising),
             (low, falling, high), (rising, low, high), (high, low, falling)]
    step = F.pmod(sector, F.lit(6))
    channels = []
    for channel in range(3):
        value = F.lit(None).cast("double")
        for at in range(5, -1, -1):
            value = F.when(step == at, wheel[at][channel]).otherwise(value)
        channels.append(F.floor(value * 255))
    return _hex(*channels)


def stored_or_stable(stored: Column, cluster: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(stored), F.lit("")), stable_color(cluster))


def palette_color(rank: Column, count: Column, palette: list[str], recycle: bool = False) -> Column:
    """Colour of the 1-based rank; the last rank, and any beyond the palette, is grey."""
    colors = F.array(*[F.lit(c) for c in palette])
    place = (F.pmod(rank - 1, F.lit(len(palette))) + 1) if recycle else rank
    picked = F.get(colors, (place - 1).cast("int"))
    return F.when(rank == count, F.lit(GREY)).otherwise(F.coalesce(picked, F.lit(GREY)))


def ramp_lightness(rank: Column, count: Column) -> Column:
    """Lightness of the 1-based rank among ``count`` sub-clusters."""
    return F.lit(RAMP_LOW) + F.lit(RAMP_HIGH - RAMP_LOW) * (rank - 1) / F.greatest(count - 1, F.lit(1))


def hue_and_saturation(color: Column) -> tuple[Column, Column]:
    red, green, blue = [F.conv(F.substring(color, at, 2), 16, 10).cast("double") / 255.0
                        for at in (2, 4, 6)]
    top, bottom = F.greatest(red, green, blue), F.least(red, green, blue)
    spread, total = top - bottom, top + bottom
    sat = F.when(spread == 0, F.lit(0.0)).when(total <= 1.0, spread / F.nullif(total, F.lit(0.0))) \
        .otherwise(spread / F.nullif(2.0 - total, F.lit(0.0)))
    width = F.nullif(spread, F.lit(0.0))
    hue = F.when(spread == 0, F.lit(0.0)) \
        .when(red == top, (green - blue) / width) \
        .when(green == top, 2.0 + (blue - red) / width) \
        .otherwise(4.0 + (red - green) / width) / 6.0
    return hue - F.floor(hue), sat


def shade(hue: Column, sat: Column, lightness: Column) -> Column:
    """The colour of a hue and saturation at some lightness; the arguments should be plain columns, they are used often."""
    upper = F.when(lightness <= 0.5, lightness * (1.0 + sat)).otherwise(lightness + sat - lightness * sat)
    lower = 2.0 * lightness - upper

    def channel(turn: float) -> Column:
        at = hue + F.lit(turn)
        at = at - F.floor(at)
        value = F.when(at < 1 / 6, lower + (upper - lower) * 6.0 * at) \
            .when(at < 1 / 2, upper) \
            .when(at < 2 / 3, lower + (upper - lower) * (2 / 3 - at) * 6.0) \
            .otherwise(lower)
        return F.bround(value * 255.0, 0)

    return _hex(channel(1 / 3), channel(0.0), channel(-1 / 3))
