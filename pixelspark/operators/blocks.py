"""Block operator: cut images into tiles with a halo, run an array kernel on each, trim.

One shuffle brings each tile together. A tile holds at most (block + 2 halo)^2 pixels, so an
image of any size is spread over many tasks and no task ever sees a whole image.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pixelspark.schema import IC, IMG

BLOCK = 256
ENDLESS = 1 << 30
Kernel = Callable[..., "np.ndarray | Sequence[np.ndarray]"]


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition in front of Python work, keeping every shuffle partition.

    Adaptive execution merges partitions by their bytes; few bytes can mean much work here.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def pair(v: int | tuple[int, int]) -> tuple[int, int]:
    """A number for rows and columns."""
    return (v, v) if isinstance(v, int) else (int(v[0]), int(v[1]))


def image_keys(keys: Sequence[str]) -> list[str]:
    """The keys that name an image; all of them where none does."""
    return [k for k in keys if k in IMG] or list(keys)


def image_size(df: DataFrame, keys: Sequence[str] = tuple(IMG)) -> DataFrame:
    """One row per image: height and width, from the largest stored y and x."""
    return df.groupBy(*image_keys(keys)).agg(*[(F.max(c) + 1).cast("int").alias(s) for c, s in (("y", "height"), ("x", "width"))])


def _owners(c: str, block: int, halo: int, limit: str | None) -> Column:
    """Indices of the tiles whose halo holds coordinate ``c``."""
    first = F.greatest(F.floor((F.col(c) - halo) / block), F.lit(0))
    last = F.floor((F.col(c) + halo) / block)
    if limit is not None:
        last = F.least(last, F.floor((F.col(limit) - 1) / block))
    return F.sequence(first, last).cast("array<int>")


def with_halo(df: DataFrame, block: int | tuple[int, int] = BLOCK, halo: int | tuple[int, int] = 0,
              shape: tuple[str, str] | None = None) -> DataFrame:
    """Add the tile indices ``ty``/``tx``; pixels near a tile border are repeated."""
    for c, tile, b, r, limit in zip(("y", "x"), ("ty", "tx"), pair(block), pair(halo), shape or (None, None)):
        at = F.floor(F.col(c) / b).cast("int") if r == 0 else F.explode(_owners(c, b, r, limit))
        df = df.withColumn(tile, at)
    return df


def tile_marks(size: DataFrame, keys: Sequence[str], block: int | tuple[int, int]) -> DataFrame:
    """One row per tile of each image: (keys, ty, tx, y = -height, x = -width)."""
    last = {c: F.floor((F.col(s) - 1) / b).cast("int") for c, s, b in zip(("ty", "tx"), ("height", "width"), pair(block))}
    marks = size.where("height > 0 and width > 0")
    for c, to in last.items():
        marks = marks.withColumn(c, F.explode(F.sequence(F.lit(0), to)))
    return marks.select(*keys, "ty", "tx", (-F.col("height")).cast("int").alias("y"), (-F.col("width")).cast("int").alias("x"))


def sized_tiles(df: DataFrame, keys: Sequence[str], halo: int | tuple[int, int], block: int | tuple[int, int], size: DataFrame) -> DataFrame:
    """``df`` in tiles, sorted, with the size of the image in front of each tile.

    The size is a row of its own that is sent to every tile, told by its negative y and x: no pixel is joined to its image,
    so an image of any size stays spread over its tiles. Tiles are dealt by image; further keys, as channels, follow each
    other in a tile.
    """
    image = image_keys(keys)
    rows = with_halo(df, block, halo)
    marks = tile_marks(size, image, block)
    types = {f.name: f.dataType for f in rows.schema}
    both = rows.union(marks.select(*[F.col(c).cast(types[c]) if c in marks.columns else F.lit(None).cast(types[c]).alias(c) for c in rows.columns]))
    tile = [*image, "ty", "tx"]
    return spread(both, *tile).sortWithinPartitions(*tile, *[k for k in keys if k not in image], F.col("y") >= 0)


class Sizes:
    """Reads the marks in front of tiles as they come by."""

    def __init__(self, image: Sequence[str]):
        self.names, self.owner, self.size = [*image, "ty", "tx"], None, (0, 0)

    def of(self, table: pa.Table, y: np.ndarray, x: np.ndarray, s: slice) -> tuple[slice, tuple[int, int] | None]:
        """(rows of the tile without marks, height and width of its image); None where the tile lies outside the image."""
        key = tuple(table.column(k)[s.start].as_py() for k in self.names)
        a = s.start
        while a < s.stop and y[a] < 0:
            self.owner, self.size = key, (-int(y[a]), -int(x[a]))
            a += 1
        return slice(a, s.stop), self.size if a < s.stop and key == self.owner else None

    def spans(self, table: pa.Table, y: np.ndarray, x: np.ndarray, starts: np.ndarray) -> list[tuple[slice, tuple[int, int]]]:
        """What ``of`` gives for all tiles of a table, without those outside their image."""
        keys, out = zip(*[table.column(k).take(pa.array(starts)).to_pylist() for k in self.names]), []
        ends, sign = [*starts[1:].tolist(), table.num_rows], y < 0
        for key, a, b in zip(keys, starts.tolist(), ends):
            while a < b and sign[a]:
                self.owner, self.size = key, (-int(y[a]), -int(x[a]))
                a += 1
            if a < b and key == self.owner:
                out.append((slice(a, b), self.size))
        return out


def whole_tiles(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Regroup sorted batches so that no tile is cut; yields a table and its tile starts.

    Holds one batch and one unfinished tile at a time.
    """
    held: list[pa.RecordBatch] = []
    last_key = None
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        change = np.zeros(n, bool)
        for k in keys:
            c = batch.column(k)
            here, before = c.slice(1), c.slice(0, n - 1)
            change[1:] |= pc.fill_null(pc.not_equal(here, before), False).to_numpy(False)
            change[1:] |= here.is_null().to_numpy(False) != before.is_null().to_numpy(False)
        first_key = tuple(batch.column(k)[0].as_py() for k in keys)
        change[0] = last_key is not None and first_key != last_key
        last_key = tuple(batch.column(k)[n - 1].as_py() for k in keys)
        cuts = np.flatnonzero(change)
        if cuts.size == 0:
            held.append(batch)
            continue
        size = sum(b.num_rows for b in held)
        done = pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
        starts = np.concatenate([[0], cuts[:-1] + size]) if size or cuts[0] else cuts[:-1]
        yield done, np.unique(starts)
        held = [batch.slice(cuts[-1])]
    if held:
        yield pa.Table.from_batches(held), np.zeros(1, int)


class _Tile:
    """Geometry of one tile: the stored region, with its halo and cut at the image border, and the core inside it."""

    def __init__(self, ty: int, tx: int, block: int | tuple[int, int], halo: int | tuple[int, int], hw: tuple[int, int]):
        (by, bx), (ry, rx), (h, w) = pair(block), pair(halo), hw
        self.y0, self.x0 = max(0, int(ty) * by - ry), max(0, int(tx) * bx - rx)
        y1, x1 = min(int(h), (int(ty) + 1) * by + ry), min(int(w), (int(tx) + 1) * bx + rx)
        self.shape = (y1 - self.y0, x1 - self.x0)
        self.core = (slice(max(int(ty) * by - self.y0, 0), max(min((int(ty) + 1) * by, y1) - self.y0, 0)),
                     slice(max(int(tx) * bx - self.x0, 0), max(min((int(tx) + 1) * bx, x1) - self.x0, 0)))
        self.empty = any(c.start >= c.stop for c in self.core)

    def trim(self, y: np.ndarray, x: np.ndarray) -> None:
        """End the tile of an endless image with its last stored row and column: what lies behind holds nothing."""
        self.shape = (min(self.shape[0], int(y.max()) - self.y0 + 1), min(self.shape[1], int(x.max()) - self.x0 + 1))
        self.core = tuple(slice(c.start, max(c.start, min(c.stop, n))) for c, n in zip(self.core, self.shape))
        self.empty = any(c.start >= c.stop for c in self.core)

    def put(self, a: np.ndarray, y: np.ndarray, x: np.ndarray, value: np.ndarray) -> None:
        """Store values at their places; those behind the border of the image are left out."""
        y, x = y - self.y0, x - self.x0
        if y.max() >= a.shape[0] or x.max() >= a.shape[1]:
            inside = (y < a.shape[0]) & (x < a.shape[1])
            y, x, value = y[inside], x[inside], value[inside]
        a[y, x] = value


def _rows(core: tuple[slice, slice], y0: int, x0: int, result, inside: np.ndarray | None = None):
    """Coordinates and values of the core pixels, only those ``inside`` where it is given."""
    if inside is None:
        gy, gx = (g.ravel() for g in np.mgrid[core])
    else:
        gy, gx = np.nonzero(inside[core] > 0)
        gy, gx = gy + core[0].start, gx + core[1].start
    result = [result] if isinstance(result, np.ndarray) else result
    return gy + y0, gx + x0, [np.asarray(a, np.float64)[gy, gx] for a in result]


def _long_schema(df: DataFrame, keys: Sequence[str], out: Sequence[str]) -> T.StructType:
    return T.StructType([*df.select(*keys).schema.fields, T.StructField("y", T.IntegerType()),
                         T.StructField("x", T.IntegerType()), *[T.StructField(o, T.DoubleType()) for o in out]])


def _long_batch(table: pa.Table | pa.RecordBatch, keys: Sequence[str], made: list, schema: pa.Schema) -> pa.RecordBatch:
    """One batch from (row of the keys, (ys, xs, values)) pairs."""
    rows = pa.array(np.concatenate([np.full(m[0].size, row) for row, m in made]))
    data = []
    for k, f in zip(keys, schema):
        c = table.column(k).take(rows)
        data.append((c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c).cast(f.type))
    data += [pa.array(np.concatenate([m[i] for _, m in made]).astype(np.int32)) for i in (0, 1)]
    for parts in zip(*[m[2] for _, m in made]):
        v = np.concatenate(parts)
        data.append(pa.array(v, mask=np.isnan(v)))
    return pa.RecordBatch.from_arrays(data, schema=schema)


def _spans(starts: np.ndarray, end: int) -> Iterator[slice]:
    for a, b in zip(starts, [*starts[1:], end]):
        yield slice(int(a), int(b))


#: Pixels of tiles that are stacked at once.
STACK_PIXELS = 1 << 17


def _lowest(v: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The smallest value of each span, none of them empty."""
    return np.minimum.reduceat(np.append(v, 0), np.stack([starts, ends], 1).ravel())[::2]


def stacked_rows(col: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray, h: np.ndarray, w: np.ndarray,
                 block: int) -> tuple[Iterator[tuple[np.ndarray, tuple[int, int], tuple[np.ndarray, ...]]], np.ndarray]:
    """(equal-sized images that one tile holds, a few at a time: their places among the spans, height and width, and of their pixels the place
    in the stack, y, x and row; whether a span is such an image)."""
    alone = (col["ty"][starts] == 0) & (col["tx"][starts] == 0) & (h > 0) & (h <= block) & (w > 0) & (w <= block)
    if len(starts):
        alone &= (_lowest(col["y"], starts, ends) >= 0) & (_lowest(col["x"], starts, ends) >= 0)

    def made() -> Iterator[tuple[np.ndarray, tuple[int, int], tuple[np.ndarray, ...]]]:
        pick = np.flatnonzero(alone)
        code = h[pick].astype(np.int64) * (block + 1) + w[pick].astype(np.int64)
        for size in np.unique(code):
            hw = (int(size) // (block + 1), int(size) % (block + 1))
            same, step = pick[code == size], max(1, STACK_PIXELS // (hw[0] * hw[1]))
            for part in (same[i:i + step] for i in range(0, len(same), step)):
                n = ends[part] - starts[part]
                rows = np.repeat(starts[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                tile, y, x = np.repeat(np.arange(len(part)), n), col["y"][rows], col["x"][rows]
                inside = (y < hw[0]) & (x < hw[1])
                yield part, hw, (tile[inside], y[inside], x[inside], rows[inside])

    return made(), alone


def _stacks(col: dict[str, np.ndarray], starts: np.ndarray, end: int, block: int, values: Sequence[str], fill: Sequence[float | str],
            shape: tuple[str, str] | None, spans: Sequence[tuple[slice, tuple[int, int]]] | None = None) -> tuple[Iterator[tuple[np.ndarray, list[np.ndarray]]], np.ndarray]:
    """(stacks of equal-sized images that one tile holds: their first rows and an array (image, y, x) per value; starts of all other tiles).

    Without ``shape`` images are endless and end with the last stored row and column; ``spans`` gives rows, height and width of each.
    """
    if spans is not None:
        starts, ends = (np.array([getattr(s, c) for s, _ in spans], np.int64) for c in ("start", "stop"))
        h, w = (np.array([hw[i] for _, hw in spans], np.int64) for i in (0, 1))
    else:
        ends = np.append(starts[1:], end)
        h, w = (col[c][starts] for c in shape) if shape else (np.maximum.reduceat(col[c], starts) + 1 for c in ("y", "x"))
    stacks, alone = stacked_rows(col, starts, ends, h, w, block)

    def made() -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        for part, hw, (tile, y, x, rows) in stacks:
            arrays = []
            for name, f in zip(values, fill):
                a = np.empty((len(part), *hw))
                a[:] = col[f][starts[part]][:, None, None] if isinstance(f, str) else f
                a[tile, y, x] = col[name][rows]
                arrays.append(a)
            yield starts[part], arrays

    return made(), starts[~alone]


def _stack_rows(first: np.ndarray, result: Sequence[np.ndarray], inside: np.ndarray | None) -> tuple[np.ndarray, tuple]:
    """First row, coordinates and values of the pixels of a stack, only those ``inside`` where it is given."""
    t, gy, gx = np.nonzero(inside > 0 if inside is not None else np.ones(result[0].shape, bool))
    return first[t], (gy, gx, [np.asarray(a, np.float64)[t, gy, gx] for a in result])


def map_blocks(df: DataFrame, kernel: Kernel, out: Sequence[str], *,
               values: Sequence[str] = ("value",), keys: Sequence[str] = tuple(IC),
               halo: int | tuple[int, int] = 0, block: int | tuple[int, int] = BLOCK, fill: Sequence[float | str] | None = None,
               shape: tuple[str, str] | None = None, keep: str | None = None, size: DataFrame | None = None,
               endless: bool = False, core: bool = False, stack: bool = False) -> DataFrame:
    """Run ``kernel(*arrays) -> array(s)`` on every tile and return long rows.

    The kernel gets the tile with its halo, cut at the image border, and returns arrays of
    the same shape; only the core of the tile is kept. It handles its own boundary mode: an
    edge of the array is either an image border or lies ``halo`` away from the core.

    ``values`` are the columns turned into arrays, ``fill`` what a missing pixel holds (NaN;
    a column name takes it from the data). ``size`` has height and width of each image and spares a pass over the pixels;
    without it an image ends at the largest y and x stored of it, so a sparse relation gives it. ``shape`` names height and
    width columns of ``df`` instead. ``endless`` images have no border: a kernel sees ``fill`` behind it. With ``core`` the
    kernel also gets the slices of the core, and need fill only that part of what it returns. ``keep`` names a value column: only pixels where it is positive are returned.
    With ``stack``, for images that are not endless, those of one tile and equal size are handed over together: a kernel then takes and
    returns arrays whose last two axes are those of a tile.
    """
    if any(r > b for r, b in zip(pair(halo), pair(block))):
        raise ValueError("the halo must not exceed the block")
    fill = list(fill) if fill is not None else [np.nan] * len(values)
    extra = [f for f in fill if isinstance(f, str)] + list(shape or ())
    cols = list(dict.fromkeys([*keys, "y", "x", *values, *extra]))
    tile = [*keys, "ty", "tx"]
    sized = shape is None and not endless
    if sized:
        tiles = sized_tiles(df.select(*cols), keys, halo, block, size if size is not None else image_size(df, keys))
    else:
        tiles = spread(with_halo(df.select(*cols), block, halo, shape), *tile).sortWithinPartitions(*tile)
    schema = _long_schema(tiles, keys, out)
    arrow = to_arrow_schema(schema)

    def one_tile(col: dict[str, np.ndarray], s: slice, hw: tuple[int, int]):
        t = _Tile(col["ty"][s.start], col["tx"][s.start], block, halo, hw)
        if endless:
            t.trim(col["y"][s], col["x"][s])
        if t.empty:
            return None
        arrays = {}
        for name, f in zip(values, fill):
            a = np.full(t.shape, col[f][s.start] if isinstance(f, str) else f, np.float64)
            t.put(a, col["y"][s], col["x"][s], col[name][s])
            arrays[name] = a
        result = kernel(*arrays.values(), **({"core": t.core} if core else {}))
        return _rows(t.core, t.y0, t.x0, result, arrays[keep] if keep else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(image_keys(keys))
        for table, starts in whole_tiles(batches, tile):
            col = {c: table.column(c).to_numpy() for c in ["ty", "tx", *cols] if c not in keys}
            made = []
            if sized:
                spans = sizes.spans(table, col["y"], col["x"], starts)
            else:
                spans = [(s, (ENDLESS, ENDLESS) if endless else tuple(col[c][s.start] for c in shape)) for s in _spans(starts, table.num_rows)]
            if stack:
                bulk, others = _stacks(col, starts, table.num_rows, min(pair(block)), values, fill, shape, spans)
                for first, arrays in bulk:
                    result = kernel(*arrays)
                    made.append(_stack_rows(first, [result] if isinstance(result, np.ndarray) else result, arrays[list(values).index(keep)] if keep else None))
                others = set(others.tolist())
                spans = [(s, hw) for s, hw in spans if s.start in others]
            for s, hw in spans:
                if (one := one_tile(col, s, hw)) is not None:
                    made.append((s.start, one))
            if made:
                yield _long_batch(table, keys, made, arrow)

    return tiles.mapInArrow(run, schema)


def reduce_blocks(df: DataFrame, kernel: Callable[..., Sequence[np.ndarray]], out: str, *, values: Sequence[str] = ("value",),
                  keys: Sequence[str] = tuple(IC), halo: int = 0, block: int = BLOCK, fill: Sequence[float | str] | None = None,
                  shape: tuple[str, str] | None = None, place: bool = False, stacked: Callable[..., Sequence[np.ndarray]] | None = None) -> DataFrame:
    """Run ``kernel(*arrays, core) -> columns`` on every tile: any rows per tile instead of one per pixel, to be added up.

    ``out`` is the schema of the columns. Without ``shape`` images are endless: a kernel sees ``fill`` where nothing is stored,
    also behind a border, and the array ends with the last stored row and column. With it, as in ``map_blocks``, the array ends
    there. With ``place`` the kernel also gets ``origin``, row and column of the first pixel of the core, always a whole one,
    and the result has the columns ``ty`` and ``tx`` of the tile. ``stacked(*arrays) -> (place in the stack, *columns)`` takes
    images of one tile and equal size together, as arrays (image, y, x) that are all core.
    """
    if halo > block:
        raise ValueError("the halo must not exceed the block")
    fill = list(fill) if fill is not None else [np.nan] * len(values)
    cols = list(dict.fromkeys(["y", "x", *values, *[f for f in fill if isinstance(f, str)], *(shape or ())]))
    tile = [*keys, "ty", "tx"]
    tiles = spread(with_halo(df.select(*keys, *cols), block, halo, shape), *tile).sortWithinPartitions(*tile)
    lead = tile if place else list(keys)
    schema = T.StructType([*tiles.select(*lead).schema.fields, *T.StructType.fromDDL(out).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_tiles(batches, tile):
            col = {c: table.column(c).to_numpy() for c in ("ty", "tx", *cols)}
            first, made, spans = [], [], list(_spans(starts, table.num_rows))
            if stacked:
                bulk, others = _stacks(col, starts, table.num_rows, block, values, fill, shape)
                for rows, arrays in bulk:
                    at, *got = stacked(*arrays)
                    if len(at):
                        first.append(rows[at])
                        made.append(got)
                others = set(others.tolist())
                spans = [s for s in spans if s.start in others]
            for s in spans:
                hw = tuple(col[c][s.start] for c in shape) if shape else (ENDLESS, ENDLESS)
                t = _Tile(col["ty"][s.start], col["tx"][s.start], block, halo, hw)
                if not shape and not place:
                    t.trim(col["y"][s], col["x"][s])
                if t.empty:
                    continue
                arrays = []
                for name, f in zip(values, fill):
                    a = np.full(t.shape, col[f][s.start] if isinstance(f, str) else f, np.float64)
                    t.put(a, col["y"][s], col["x"][s], col[name][s])
                    arrays.append(a)
                got = kernel(*arrays, core=t.core, **({"origin": (t.y0 + t.core[0].start, t.x0 + t.core[1].start)} if place else {}))
                if len(got[0]):
                    first.append(np.full(len(got[0]), s.start))
                    made.append(got)
            if made:
                data = [table.column(k).take(pa.array(np.concatenate(first))).combine_chunks().cast(f.type) for k, f in zip(lead, arrow)]
                data += [pa.array(np.concatenate(parts)).cast(f.type) for parts, f in zip(zip(*made), list(arrow)[len(lead):])]
                yield pa.RecordBatch.from_arrays(data, schema=arrow)

    return tiles.mapInArrow(run, schema)


_GEOMETRY = ("y0", "x0", "h", "w", "top", "left", "bottom", "right")


def pack_tiles(pixels: DataFrame, halo: int, block: int = BLOCK, value: str = "value",
               keys: Sequence[str] = tuple(IC), size: DataFrame | None = None) -> DataFrame:
    """One row per tile with its halo: (keys, ty, tx, geometry, vals).

    Written once, the tiles serve any kernel that reaches no further than ``halo`` without
    another shuffle; see :func:`map_tiles`. ``top`` to ``right`` bound the core.
    """
    tile = [*keys, "ty", "tx"]
    px = pixels.select(*keys, "y", "x", F.col(value).cast("double").alias("value"))
    tiles = sized_tiles(px, keys, halo, block, size if size is not None else image_size(px, keys))
    schema = T.StructType([*tiles.select(*tile).schema.fields, *[T.StructField(g, T.IntegerType()) for g in _GEOMETRY],
                           T.StructField("vals", T.ArrayType(T.DoubleType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(image_keys(keys))
        for table, starts in whole_tiles(batches, tile):
            col = {c: table.column(c).to_numpy() for c in ("ty", "tx", "y", "x", "value")}
            first, geometry, vals = [], [], []
            for s in _spans(starts, table.num_rows):
                s, hw = sizes.of(table, col["y"], col["x"], s)
                if hw is None:
                    continue
                t = _Tile(col["ty"][s.start], col["tx"][s.start], block, halo, hw)
                if t.empty:
                    continue
                a = np.full(t.shape, np.nan)
                t.put(a, col["y"][s], col["x"][s], col["value"][s])
                first.append(s.start)
                geometry.append((t.y0, t.x0, *t.shape, t.core[0].start, t.core[1].start, t.core[0].stop, t.core[1].stop))
                vals.append(a.ravel())
            if not first:
                continue
            data = [table.column(k).take(pa.array(first)).combine_chunks().cast(f.type) for k, f in zip(tile, arrow)]
            data += [pa.array(np.array(g, np.int32)) for g in zip(*geometry)]
            ends = np.concatenate([[0], np.cumsum([v.size for v in vals])]).astype(np.int32)
            flat = np.concatenate(vals)
            data.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, mask=np.isnan(flat))))
            yield pa.RecordBatch.from_arrays(data, schema=arrow)

    return tiles.mapInArrow(run, schema)


def map_tiles(tiles: DataFrame, kernel: Kernel, out: Sequence[str], keys: Sequence[str] = tuple(IC)) -> DataFrame:
    """Run a kernel on packed tiles; rows stay where they are."""
    schema = _long_schema(tiles, keys, out)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            geo = [batch.column(g).to_numpy() for g in _GEOMETRY]
            for i in range(batch.num_rows):
                y0, x0, h, w, top, left, bottom, right = (int(g[i]) for g in geo)
                a = batch.column("vals")[i].values.to_numpy(zero_copy_only=False).reshape(h, w)
                made = _rows((slice(top, bottom), slice(left, right)), y0, x0, kernel(a))
                yield _long_batch(batch, keys, [(i, made)], arrow)

    return tiles.select(*keys, *_GEOMETRY, "vals").mapInArrow(run, schema)
