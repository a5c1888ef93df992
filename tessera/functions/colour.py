"""Colour-space transforms as Column expressions (whole-stage codegen, no UDF).

sRGB → CIE LAB (D65 white, 2° observer), sRGB → HSV, and LAB → sRGB for
building colour grids.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (sRGB / CIE LAB conversion):
#   sRGB linearisation: c > 0.04045 ? ((c + 0.055) / 1.055) ^ 2.4 : c / 12.92
#   linear RGB → XYZ matrix rows:
#     0.412453 0.357580 0.180423
#     0.212671 0.715160 0.072169
#     0.019334 0.119193 0.950227
#   D65 reference white: X 0.95047, Y 1.0, Z 1.08883
#   f(t) = t > 0.008856 ? t^(1/3) : 7.787 t + 16/116
#   L = 116 f(Y) - 16, a = 500 (f(X) - f(Y)), b = 200 (f(Y) - f(Z))
RGB_TO_XYZ = np.array([
    [0.412453, 0.357580, 0.180423],
    [0.212671, 0.715160, 0.072169],
    [0.019334, 0.119193, 0.950227],
])
WHITE_D65 = (0.95047, 1.0, 1.08883)
# the inverse transform is derived, not tabulated
XYZ_TO_RGB = np.linalg.inv(RGB_TO_XYZ)


def _unit(c: Column, input_bytes: bool) -> Column:
    return c / 255.0 if input_bytes else c.cast("double")


def _linear(c: Column) -> Column:
    return F.when(c > 0.04045, F.pow((c + 0.055) / 1.055, 2.4)).otherwise(c / 12.92)


def _f(t: Column) -> Column:
    return F.when(t > 0.008856, F.pow(t, 1.0 / 3.0)).otherwise(7.787 * t + 16.0 / 116.0)


def rgb_to_lab(r: Column, g: Column, b: Column, input_bytes: bool = True) -> tuple[Column, Column, Column]:
    """(L, a, b) columns for sRGB inputs (bytes 0-255, or floats 0-1)."""
    lin = [_linear(_unit(c, input_bytes)) for c in (r, g, b)]
    xyz = [sum((float(m) * c for m, c in zip(row, lin)), F.lit(0.0)) / w
           for row, w in zip(RGB_TO_XYZ, WHITE_D65)]
    fx, fy, fz = (_f(t) for t in xyz)
    return 116.0 * fy - 16.0, 500.0 * (fx - fy), 200.0 * (fy - fz)


def rgb_to_hsv(r: Column, g: Column, b: Column, input_bytes: bool = True) -> tuple[Column, Column, Column]:
    """(h, s, v), h in [0, 1). Grey (no chroma) gives h = s = 0.

    The three channels sit a third of the circle apart; the hue starts at the
    place of a channel that equals the maximum and moves by the difference of
    the other two. Where two channels share the maximum, both starts lead to
    the same hue (1/6, 1/2 or 5/6).
    """
    channels = [c.cast("double") for c in (r, g, b)]  # hue and saturation are ratios: no scaling, no rounding
    top = F.greatest(*channels)
    spread = top - F.least(*channels)
    sixths = F.coalesce(*[
        F.when(channels[k] == top, 2.0 * k + (channels[(k + 1) % 3] - channels[k - 1]) / F.nullif(spread, F.lit(0.0)))
        for k in range(3)])
    hue = F.when(top.isNotNull(), F.coalesce(F.pmod(sixths, F.lit(6.0)) / 6.0, F.lit(0.0)))
    saturation = F.when(top.isNotNull(), F.coalesce(spread / F.nullif(top, F.lit(0.0)), F.lit(0.0)))
    return hue, saturation, _unit(top, input_bytes)


def lab_to_rgb(l: Column, a: Column, b: Column) -> tuple[Column, Column, Column]:
    """sRGB in [0, 1] (clipped) for LAB inputs: the inverse of ``rgb_to_lab``."""
    fy = (l + 16.0) / 116.0
    fx = a / 500.0 + fy
    fz = F.greatest(fy - b / 200.0, F.lit(0.0))
    edge = 6.0 / 29.0

    def finv(t):
        return F.when(t > edge, F.pow(t, 3.0)).otherwise((t - 16.0 / 116.0) / 7.787)

    xyz = [finv(t) * w for t, w in zip((fx, fy, fz), WHITE_D65)]
    lin = [sum((float(m) * c for m, c in zip(row, xyz)), F.lit(0.0)) for row in XYZ_TO_RGB]

    def gamma(c):
        c = F.when(c > 0.0031308, 1.055 * F.pow(c, 1.0 / 2.4) - 0.055).otherwise(12.92 * c)
        return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))

    return tuple(gamma(c) for c in lin)


# Representative sRGB colour of each colour word.
COLOUR_RGB = {
    "red": (255, 0, 0),
    "orange": (255, 114, 0),
    "yellow": (255, 255, 0),
    "green": (0, 230, 0),
    "blue": (0, 0, 255),
    "purple": (187, 0, 187),
    "brown": (117, 60, 0),
    "pink": (255, 187, 187),
    "black": (0, 0, 0),
    "grey": (150, 150, 150),
    "white": (255, 255, 255),
}
