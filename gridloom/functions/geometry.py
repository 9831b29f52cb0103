"""Cell references and rectangles: four 1-based inclusive integer columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_ROW, MAX_COL = 1_048_576, 16_384  # fixed values of the file format


def column_number(letters: Column) -> Column:
    code = lambda x: F.ascii(x) - 64
    return F.aggregate(F.split(F.upper(letters), ""), F.lit(0), lambda acc, x: F.when(x == "", acc).otherwise(acc * 26 + code(x)))


def column_letters(number: Column) -> Column:
    """At most three letters."""
    n = number - 1
    letter = lambda k: F.char(k.cast("int") + 65)
    two, three = n - 26, n - 702
    return (
        F.when(number <= 26, letter(n))
        .when(number <= 702, F.concat(letter(F.floor(two / 26)), letter(two % 26)))
        .otherwise(F.concat(letter(F.floor(three / 676)), letter(F.floor(three / 26) % 26), letter(three % 26)))
    )


def a1(row: Column, col: Column) -> Column:
    return F.concat(column_letters(col), row.cast("string"))


@dataclass(frozen=True)
class Rect:
    """Expressions of a rectangle's corners."""

    r1: Column
    c1: Column
    r2: Column
    c2: Column

    @classmethod
    def of(cls, prefix: str = "", alias: str = "") -> Rect:
        at = f"{alias}." if alias else ""
        return cls(*(F.col(f"{at}{prefix}{n}") for n in ("min_row", "min_col", "max_row", "max_col")))

    @classmethod
    def parse(cls, ref: Column) -> Rect:
        """From A1 text; $ and sheet prefixes fall away, whole rows and columns
        reach to the format's limits."""
        bare = F.upper(F.replace(F.regexp_replace(ref, r"^.*!", ""), F.lit("$"), F.lit("")))
        left, right = F.split_part(bare, F.lit(":"), F.lit(1)), F.regexp_extract(bare, ":(.*)$", 1)
        right = F.when(right == "", left).otherwise(right)

        def part(text: Column, pattern: str, number, missing: int) -> Column:
            got = F.regexp_extract(text, pattern, 1)
            return F.when(got == "", F.lit(missing)).otherwise(number(got)).cast("int")

        row, col = (r"(\d+)$", lambda x: x.cast("int")), (r"^([A-Z]+)", column_number)
        ends = [part(left, row[0], row[1], 1), part(left, col[0], col[1], 1), part(right, row[0], row[1], MAX_ROW), part(right, col[0], col[1], MAX_COL)]
        ok = bare.rlike(r"^(?:[A-Z]{1,3}\d+(?::[A-Z]{1,3}\d+)?|[A-Z]{1,3}:[A-Z]{1,3}|\d+:\d+)$")
        ordered = (F.least(ends[0], ends[2]), F.least(ends[1], ends[3]), F.greatest(ends[0], ends[2]), F.greatest(ends[1], ends[3]))
        return cls(*(F.when(ok, x) for x in ordered))

    @property
    def ref(self) -> Column:
        one = (self.r1 == self.r2) & (self.c1 == self.c2)
        return F.when(one, a1(self.r1, self.c1)).otherwise(F.concat(a1(self.r1, self.c1), F.lit(":"), a1(self.r2, self.c2)))

    @property
    def height(self) -> Column:
        return self.r2 - self.r1 + 1

    @property
    def width(self) -> Column:
        return self.c2 - self.c1 + 1

    @property
    def area(self) -> Column:
        return self.height.cast("long") * self.width

    def contains(self, row: Column, col: Column) -> Column:
        return row.between(self.r1, self.r2) & col.between(self.c1, self.c2)

    def contains_rect(self, other: Rect) -> Column:
        return (self.r1 <= other.r1) & (self.c1 <= other.c1) & (self.r2 >= other.r2) & (self.c2 >= other.c2)

    def intersects(self, other: Rect) -> Column:
        return (self.r1 <= other.r2) & (other.r1 <= self.r2) & (self.c1 <= other.c2) & (other.c1 <= self.c2)

    def intersection_area(self, other: Rect) -> Column:
        rows = F.least(self.r2, other.r2) - F.greatest(self.r1, other.r1) + 1
        cols = F.least(self.c2, other.c2) - F.greatest(self.c1, other.c1) + 1
        return F.greatest(rows, F.lit(0)).cast("long") * F.greatest(cols, F.lit(0))

    def iou(self, other: Rect) -> Column:
        both = self.intersection_area(other)
        return both / (self.area + other.area - both)

    def union(self, other: Rect) -> Rect:
        return Rect(F.least(self.r1, other.r1), F.least(self.c1, other.c1), F.greatest(self.r2, other.r2), F.greatest(self.c2, other.c2))

    def distance(self, other: Rect) -> Column:
        """Row and column gaps, summed: next to each other is 1."""
        gap = lambda a1, a2, b1, b2: F.greatest(F.lit(0), b1 - a2, a1 - b2)
        return gap(self.r1, self.r2, other.r1, other.r2) + gap(self.c1, self.c2, other.c1, other.c2)

    def columns(self, prefix: str = "") -> list[Column]:
        return [x.alias(f"{prefix}{n}") for x, n in zip((self.r1, self.c1, self.r2, self.c2), ("min_row", "min_col", "max_row", "max_col"), strict=True)]

    @property
    def is_full_axis(self) -> Column:
        return ((self.r1 == 1) & (self.r2 == MAX_ROW)) | ((self.c1 == 1) & (self.c2 == MAX_COL))
