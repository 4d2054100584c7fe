"""Art shapes, garment tones, placement and crop geometry."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from .. import values


def shape(width: Column, height: Column) -> Column:
    """portrait / square / landscape; null without a height."""
    ratio = F.try_divide(width, height)
    return (F.when(ratio < values.PORTRAIT_BELOW, "portrait")
            .when(ratio > values.LANDSCAPE_ABOVE, "landscape")
            .when(ratio.isNotNull(), "square"))


def tone(stem: Column) -> Column:
    """light / dark / mid by the words of a file name."""
    words = F.split(F.regexp_replace(F.lower(stem), "[-_]", " "), " ")

    def has(wanted: Sequence[str]) -> Column:
        # A two-word entry cannot match: the separators were replaced by blanks.
        return F.arrays_overlap(words, F.array(*[F.lit(w) for w in wanted]))

    return F.when(has(values.LIGHT_WORDS), "light").when(has(values.DARK_WORDS), "dark").otherwise(
        "mid")


def chosen_blend(auto: Column, configured: Column, tone_column: Column) -> Column:
    """The blend mode of the tone; a config that switches this off (false) keeps its own."""
    return F.when(F.coalesce(auto, F.lit(True)), blend_mode(tone_column)).otherwise(configured)


def blend_mode(tone_column: Column, light: str = "multiply", mid: str = "multiply",
               dark: str = "screen") -> Column:
    return F.when(tone_column == "light", light).when(tone_column == "dark", dark).otherwise(mid)


def config_key(stem: Column, keys: Sequence[str], fallback: bool = True) -> Column:
    """Placement config of a mock-up file name.

    The longest key contained in the name; else the key whose last part stands in the name
    without a letter on either side; else the first key, or null without ``fallback``.
    """
    lowered = F.lower(stem)
    by_length = sorted(keys, key=len, reverse=True)
    whole = [F.when(lowered.contains(k.lower()), F.lit(k)) for k in by_length]
    suffix = [F.when(lowered.rlike(f"(?<![a-z]){re.escape(k.split('_')[-1].lower())}(?![a-z])"),
                     F.lit(k)) for k in by_length if "_" in k]
    last = [F.lit(keys[0])] if fallback and keys else []
    return F.coalesce(*whole, *suffix, *last)


def config_value(key: Column, shape_column: Column, configs: Mapping[str, Mapping],
                 field: str, default=None) -> Column:
    """One placement parameter, the override of the art's shape winning over the base.

    The configs are a handful of hand-written entries, so the lookup is an expression.
    """
    def pick(source: Mapping):
        value = source.get(field)
        return F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) \
            else F.lit(value)

    result = None
    for name, config in configs.items():
        value = pick(config) if field in config else F.lit(default)
        for kind, override in config.get("shape_overrides", {}).items():
            if field in override:
                value = F.when(shape_column == kind, pick(override)).otherwise(value)
        result = F.when(key == name, value) if result is None else result.when(key == name, value)
    return result


def placement(mock_w: Column, mock_h: Column, art_w: Column, art_h: Column, scale: Column,
              scale_by: Column, anchor_x: Column, anchor_y: Column) -> Column:
    """Struct of scaled size and top-left corner, all cut to whole pixels."""
    by_height = scale_by == "height"
    tall = (mock_h * scale).cast("int")
    wide = (mock_w * scale).cast("int")
    new_w = F.when(by_height, F.try_divide(art_w * tall, art_h).cast("int")).otherwise(wide)
    new_h = F.when(by_height, tall).otherwise(F.try_divide(art_h * wide, art_w).cast("int"))
    left = (anchor_x * mock_w).cast("int") - F.floor(new_w / 2).cast("int")
    top = (anchor_y * mock_h).cast("int") - F.floor(new_h / 2).cast("int")
    return F.struct(new_w.alias("new_w"), new_h.alias("new_h"), left.alias("left"),
                    top.alias("top"))


def crop_box(x: Column, y: Column, w: Column, h: Column, img_w: Column, img_h: Column) -> Column:
    """Crop rectangle clamped to the image; null when it starts outside."""
    box = F.struct(F.greatest(F.lit(0), x).alias("left"), F.greatest(F.lit(0), y).alias("top"),
                   F.least(img_w, x + w).alias("right"), F.least(img_h, y + h).alias("bottom"))
    return F.when((x < img_w) & (y < img_h), box)


def has_back(w_back: Column, h_back: Column) -> Column:
    return (w_back > 0) & (h_back > 0)


def image_at(images: Column, index: Column) -> Column:
    """Image by 1-based index, the first image when that is empty; an index below 1 means 1."""
    wanted = F.when(index > 0, index).otherwise(F.lit(1))
    return F.coalesce(F.nullif(F.get(images, wanted - 1), F.lit("")),
                      F.nullif(F.get(images, F.lit(0)), F.lit("")))


def image_column_at(images: Column, index: Column) -> Column:
    """Name of the column ``image_at`` took its value from."""
    wanted = F.when(index > 0, index).otherwise(F.lit(1))
    return F.when(F.nullif(F.get(images, wanted - 1), F.lit("")).isNotNull(),
                  F.concat(F.lit("image_"), wanted.cast("string"))).otherwise(F.lit("image_1"))


def pair_key(stem: Column) -> Column:
    """File stem with the side markers removed, to pair fronts and backs."""
    cleaned = F.lower(stem)
    for marker in values.SIDE_MARKERS:
        cleaned = F.replace(cleaned, F.lit(marker), F.lit(""))
    return F.regexp_replace(cleaned, "^[_-]+|[_-]+$", "")
