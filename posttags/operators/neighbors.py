"""Exact K nearest neighbours and the tag vote.

A small sample of train posts, the scouts, steers the search. Their main axes give every
vector a shadow: its coordinates on these axes and the length of the rest. Shadows are never
farther apart than the vectors. Every train post is filed under the pivot, one of the scouts,
whose shadow is closest, and each cell is known by the box around its shadows. The K-th
distance of a test post to the scouts bounds its K-th distance to all posts, so cells whose
box lies beyond that hold no neighbour.

Cells are cut into blocks, and blocks of neighbouring cells are laid together in a few tiles
of equal size. A test post goes to the tiles that hold a cell within its bound, once to each,
so what is shuffled grows with the posts and not with cells, blocks or pairs. Vectors travel
packed: places and values of what is not 0, or all values, whichever is shorter. A task
compares one chunk of test posts with one tile, block by block, by a matrix product; it skips
blocks whose box lies beyond the best so far, and passes on the K best per test post. A window
merges them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from posttags.functions import text as tx
from posttags.session import materialise
from posttags.skew import HOT_ROWS, lookup

DIGITS = 9  # distances are rounded to this many digits, then ties go to the lower id
MAX_PIVOTS = 1024
SCOUTS = 1024
AXES = 8  # more axes make tighter boxes of more sides
ROWS_PER_CELL = 250  # wanted when choosing the number of pivots
TILES, CHUNKS = 12, 12  # parts of the train and test posts, fewer when small
TILE_ROWS = 1024  # a part holds so many posts at least, if there are as many
# Packed vectors in one part at most; beyond that there are more parts. What is sent beyond that
# grows with the square of the posts over this size; a task holds two parts, twice for a while.
TILE_BYTES = 128 << 20
SEARCH_BYTES = 8 << 20  # working memory of one numpy step


def split_by_hash(df: DataFrame, id_col: str, train_percent: int = 60) -> DataFrame:
    """Adds ``is_train`` from a hash of the id: the same split on any cluster."""
    return df.withColumn("is_train", tx.md5_bucket(F.col(id_col), 100) < train_percent)


def split_at_random(df: DataFrame, train_share: float = 0.6, seed: int = 0) -> list[DataFrame]:
    """Spark's own split; which rows land where depends on the partitions."""
    return df.randomSplit([train_share, 1 - train_share], seed=seed)


def nearest(
    test: DataFrame,
    train: DataFrame,
    k: int,
    pivots: int | None = None,
    block_rows: int | None = None,
) -> DataFrame:
    """``test_id, train_id, distance, rn``: the K nearest train posts of each test post.

    Both inputs hold ``id bigint, features array<double>`` of one length. The result is
    exact and ordered by (distance, train_id); ``pivots`` and ``block_rows`` only change
    how the work is cut.
    """
    spark = test.sparkSession
    points = materialise(_distinct_points(train, k), "knn-points")
    n_points = points.count()
    if n_points == 0:
        empty = "test_id bigint, train_id bigint, distance double, rn int"
        return spark.createDataFrame([], empty)
    if pivots is None:
        pivots = min(MAX_PIVOTS, max(1, n_points // ROWS_PER_CELL))
    guide = _scout(points, pivots)
    if block_rows is None:
        block_rows = max(64, min(4096, SEARCH_BYTES // (8 * max(1, guide.scouts.shape[1]))))

    filed = materialise(_file_points(points, guide), "knn-cells")
    boxes = _cell_boxes(filed, guide)
    tiles = _tiles(filed, len(guide.pivots), block_rows)
    visits = _plan_visits(test, guide, boxes, k, tiles.holds)
    visits = materialise(visits.withColumnRenamed("cells", "tiles"), "knn-visits")
    chunks = _n_parts(visits, CHUNKS)

    # So many partitions that two pairs of parts seldom share one.
    parts = 3 * tiles.n * chunks
    left = _spread_tests(visits, chunks).repartition(parts, "pair")
    right = _spread_points(filed, tiles, chunks).repartition(parts, "pair")
    found = left.groupBy("pair").cogroup(right.groupBy("pair")).applyInArrow(
        _search_kernel(k, guide), "test_id bigint, train_id bigint, distance double"
    )
    return _first_k(found, k)


def _first_k(found: DataFrame, k: int) -> DataFrame:
    closest = Window.partitionBy("test_id").orderBy("distance", "train_id")
    return found.withColumn("rn", F.row_number().over(closest)).where(F.col("rn") <= k)


def _distinct_points(train: DataFrame, k: int) -> DataFrame:
    """``id, ids, at, values, width``: equal vectors become one packed point with its K lowest ids.

    Equal vectors tie everywhere, so higher ids can never be among the K. The row-number
    limit runs before the shuffle, so a vector shared by many posts sends K rows per task.
    """
    packed = train.select("id", "features").mapInArrow(
        _pack, "id bigint, at binary, values binary, width int"
    )
    key = [F.xxhash64("at", "values"), *map(F.col, ("at", "values", "width"))]
    copies = Window.partitionBy(*key).orderBy("id")
    return (
        packed.withColumn("_copy", F.row_number().over(copies))
        .where(F.col("_copy") <= k)
        .groupBy(key[0].alias("hash"), *key[1:])
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.get("ids", F.lit(0)).alias("id"), "ids", "at", "values", "width")
    )


def _pack(batches):
    """``id, features`` -> ``id, at, values, width``."""
    import numpy as np

    for batch in batches:
        if batch.num_rows:
            block = _matrix(batch.column(1))
            width = pa.array(np.full(len(block), block.shape[1], np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_packed(block), width], ["id", "at", "values", "width"]
            )


def _matrix(features):
    return features.flatten().to_numpy(zero_copy_only=False).reshape(len(features), -1)


def _packed(block):
    """Each row as bytes: places (int32) and values (double) of what is not 0, or no places and
    all values, whichever is shorter. Equal rows have equal bytes."""
    import numpy as np

    width = block.shape[1]
    at, values, step = [], [], max(1, SEARCH_BYTES // 8 // max(1, width))
    for start in range(0, len(block), step):
        for row in block[start : start + step] + 0.0:
            some = np.flatnonzero(row)
            whole = 12 * len(some) >= 8 * width
            at.append(b"" if whole else some.astype("<i4").tobytes())
            values.append((row if whole else row[some]).astype("<f8").tobytes())
    return pa.array(at, pa.binary()), pa.array(values, pa.binary())


class _Vectors:
    """Packed vectors of one width; ``rows`` unpacks some of them."""

    def __init__(self, at, values, width: int):
        import numpy as np

        def parts(column, dtype):
            if isinstance(column, pa.ChunkedArray):
                column = column.combine_chunks()
            if isinstance(column, pa.ChunkedArray):
                column = pa.concat_arrays(column.chunks)
            _, offsets, data = column.buffers()
            ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
            flat = b"" if data is None else memoryview(data)[ends[0] : ends[-1]]
            size = np.dtype(dtype).itemsize
            return (ends - ends[0]) // size, np.frombuffer(flat, dtype)

        self.width, self.n = width, len(values)
        self.ends, self.values = parts(values, "<f8")
        at_ends, at = parts(at, "<i4")
        self.whole = len(at) == 0 and len(self.values) == self.n * width
        if not self.whole:
            self.at = np.empty(len(self.values), np.int32)
            lengths, places = np.diff(self.ends), np.diff(at_ends)
            sparse = np.repeat(places == lengths, lengths)
            self.at[sparse] = at
            self.at[~sparse] = np.tile(np.arange(width, dtype=np.int32), int((places != lengths).sum()))

    def rows(self, some, dtype=float):
        """The rows numbered ``some``, one line each."""
        import numpy as np

        if self.whole:
            return self.values.reshape(self.n, self.width)[some].astype(dtype)
        out = np.zeros((len(some), self.width), dtype)
        starts = self.ends[:-1][some]
        lengths = self.ends[1:][some] - starts
        before = np.cumsum(lengths) - lengths
        flat = np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)
        out[np.repeat(np.arange(len(some)), lengths), self.at[flat]] = self.values[flat]
        return out


@dataclass
class Guide:
    """What steers the search: a few vectors, their main axes, and the pivots' shadows."""

    scouts: object
    axes: object
    pivots: object


def _shadow(block, axes):
    """Coordinates on the axes, and the length of what they leave out."""
    import numpy as np

    along = block @ axes
    rest = (block * block).sum(1) - (along * along).sum(1)
    return np.column_stack([along, np.sqrt(np.maximum(rest, 0))])


def _square_distances(left, right):
    """Squared distances of all rows; a matrix product, so close pairs lose digits."""
    squares = (left * left).sum(1)[:, None] + (right * right).sum(1)[None, :]
    return squares - 2 * left @ right.T


def _scout(points: DataFrame, pivots: int, scouts: int = SCOUTS) -> Guide:
    """A hash sample of at most ``SCOUTS`` points, as a matrix on the driver."""
    import numpy as np

    pivots = min(pivots, MAX_PIVOTS)
    sample = points.orderBy(F.xxhash64("id"), "id").limit(max(scouts, pivots))
    sample = sample.select("at", "values", "width").toArrow()
    width = sample.column("width")[0].as_py()
    vectors = _Vectors(sample.column("at"), sample.column("values"), width)
    vectors = vectors.rows(np.arange(vectors.n))
    # The largest eigenvectors of the smaller of the two product matrices.
    wide = vectors.shape[1] > len(vectors)
    _, main = np.linalg.eigh(vectors @ vectors.T if wide else vectors.T @ vectors)
    main = main[:, ::-1][:, :AXES]
    axes, _ = np.linalg.qr(vectors.T @ main if wide else main)
    return Guide(vectors, axes, _shadow(vectors[:pivots], axes))


def _file_points(points: DataFrame, guide: Guide) -> DataFrame:
    """Adds ``shadow`` and ``cell``, the pivot with the closest one."""
    axes, pivots = guide.axes, guide.pivots
    step = max(1, SEARCH_BYTES // 8 // max(len(pivots), len(axes)))

    def assign(batches):
        import numpy as np

        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = _Vectors(batch.column(2), batch.column(3), len(axes))
            shadow = np.empty((vectors.n, pivots.shape[1]))
            cell = np.empty(vectors.n, dtype=np.int32)
            for start in range(0, vectors.n, step):
                some = np.arange(start, min(start + step, vectors.n))
                shadow[some] = _shadow(vectors.rows(some), axes)
                cell[some] = _square_distances(shadow[some], pivots).argmin(1)
            ends = np.arange(0, shadow.size + 1, shadow.shape[1], dtype=np.int32)
            shadows = pa.ListArray.from_arrays(pa.array(ends), pa.array(shadow.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(cell), shadows],
                ["id", "ids", "at", "values", "cell", "shadow"],
            )

    return points.mapInArrow(
        assign,
        "id bigint, ids array<bigint>, at binary, values binary, cell int, shadow array<double>",
    )


def _cell_boxes(filed: DataFrame, guide: Guide):
    """Lower and upper corner of each cell's box; at most ``MAX_PIVOTS`` rows reach the driver."""
    import numpy as np

    low = np.full(guide.pivots.shape, np.inf)
    high = np.full(guide.pivots.shape, -np.inf)
    sides = [F.get("shadow", F.lit(i)) for i in range(guide.pivots.shape[1])]
    corners = filed.groupBy("cell").agg(
        F.array(*map(F.min, sides)).alias("low"), F.array(*map(F.max, sides)).alias("high")
    )
    for row in corners.collect():
        low[row.cell], high[row.cell] = row.low, row.high
    return low, high


def _gaps(shadow, low, high):
    """Squared distance of every shadow to every box."""
    import numpy as np

    out = np.zeros((len(shadow), len(low)))
    for i in range(shadow.shape[1]):
        own = shadow[:, i, None]
        gap = np.maximum(np.maximum(low[:, i] - own, own - high[:, i]), 0)
        out += gap * gap
    return out


def _plan_visits(test: DataFrame, guide: Guide, boxes, k: int, holds=None) -> DataFrame:
    """``test_id, at, values, bound, cells``: the cells that may hold a neighbour of the post.

    With fewer than K scouts there is no bound, and every cell is visited. ``holds``, a matrix
    of cells and the parts that hold them, gives the parts of those cells instead.
    """
    scouts, axes, (low, high), rounding = guide.scouts, guide.axes, boxes, 10.0**-DIGITS
    step = max(1, SEARCH_BYTES // 8 // max(len(scouts), len(low), len(axes)))

    def choose(batches):
        import numpy as np

        filled = np.flatnonzero(np.isfinite(low[:, 0]))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            block = _matrix(batch.column(1))
            bounds, lists = np.full(len(block), np.inf), []
            for start in range(0, len(block), step):
                part = block[start : start + step]
                bound = bounds[start : start + step]
                if len(scouts) >= k:
                    square = np.partition(_square_distances(part, scouts), k - 1, axis=1)[:, k - 1]
                    # Rounding error of the product and the shadows, and of the rounded distances.
                    slack = 1e-6 * np.sqrt(1 + (part * part).sum(1) + np.maximum(square, 0))
                    bound[:] = np.sqrt(np.maximum(square, 0)) + slack + rounding
                near = _gaps(_shadow(part, axes), low[filled], high[filled]) <= (bound * bound)[:, None]
                if holds is None:
                    lists.extend(filled[row].astype(np.int32) for row in near)
                else:
                    held = near.astype(np.float32) @ holds[filled].astype(np.float32)
                    lists.extend(np.flatnonzero(row).astype(np.int32) for row in held)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_packed(block), pa.array(bounds), pa.array(lists, pa.list_(pa.int32()))],
                ["test_id", "at", "values", "bound", "cells"],
            )

    return test.select(F.col("id").alias("test_id"), "features").mapInArrow(
        choose, "test_id bigint, at binary, values binary, bound double, cells array<int>"
    )


@dataclass
class Tiles:
    """How cells are cut into blocks and laid into ``n`` tiles of equal size.

    ``table`` holds ``cell, n_blocks, first, start, rows``: a cell's blocks, the number of its
    first block, the posts before it, and the posts in each block; one row per cell. ``holds``
    says for each cell which tiles have a block of it.
    """

    n: int
    total: int
    table: DataFrame
    holds: object


def _n_parts(posts: DataFrame, wanted: int) -> int:
    """Parts for packed posts: ``wanted``, fewer for few posts and more for large ones."""
    size = posts.agg(F.count("*").alias("n"), F.sum(F.length("at") + F.length("values")).alias("bytes")).first()
    few = min(wanted, math.ceil(size.n / TILE_ROWS))
    return max(1, few, math.ceil((size.bytes or 0) / TILE_BYTES))


def _tiles(filed: DataFrame, cells: int, block_rows: int) -> Tiles:
    """At most one row per pivot reaches the driver."""
    import numpy as np

    n = _n_parts(filed, TILES)
    sizes = sorted((r.cell, r.n) for r in filed.groupBy("cell").agg(F.count("*").alias("n")).collect())
    total = sum(size for _, size in sizes)
    rows, holds, first, start = [], np.zeros((cells, n), bool), 0, 0
    for cell, size in sizes:
        n_blocks = math.ceil(size / block_rows)
        each = size / n_blocks
        rows.append((cell, n_blocks, first, start, each))
        last = int((start + (n_blocks - 1) * each) * n / total)
        holds[cell, int(start * n / total) : last + 1] = True
        first, start = first + n_blocks, start + size
    schema = "cell int, n_blocks int, first int, start bigint, rows double"
    return Tiles(n, total, filed.sparkSession.createDataFrame(rows, schema), holds)


def _spread_tests(visits: DataFrame, chunks: int) -> DataFrame:
    """Each test post falls in one chunk and meets every tile it has to."""
    chunk = F.pmod(F.xxhash64("test_id"), F.lit(chunks)).cast("int")
    pairs = F.transform("tiles", lambda tile: tile * chunks + chunk)
    return visits.select(F.explode(pairs).alias("pair"), "test_id", "at", "values", "bound")


def _spread_points(filed: DataFrame, tiles: Tiles, chunks: int) -> DataFrame:
    """Each point falls in one tile and meets every chunk of test posts."""
    within = F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int")
    tile = F.floor((F.col("start") + F.col("within") * F.col("rows")) * tiles.n / tiles.total)
    return (
        filed.join(F.broadcast(tiles.table), "cell")
        .withColumn("within", within)
        .withColumn("first_pair", tile.cast("int") * chunks)
        .select(
            F.explode(F.sequence(F.col("first_pair"), F.col("first_pair") + chunks - 1)).alias("pair"),
            (F.col("first") + F.col("within")).alias("block"),
            "ids",
            "at",
            "values",
        )
    )


def _search_kernel(k: int, guide: Guide):
    """Compares one chunk of test posts with one tile of points: K best per test post."""
    rounding, cells = 10.0**-DIGITS, SEARCH_BYTES // 8
    axes, middle = guide.axes, guide.scouts.mean(0)
    names = ["test_id", "train_id", "distance"]
    kinds = [pa.int64(), pa.int64(), pa.float64()]

    def exact(tests, points, rows, cols):
        # Direct differences: the matrix product loses digits on close pairs.
        import numpy as np

        out = np.empty(len(rows))
        step = max(1, cells // 2 // len(axes))
        for start in range(0, len(rows), step):
            some = slice(start, start + step)
            diff = tests.rows(rows[some]) - points.rows(cols[some])
            out[some] = np.sqrt((diff * diff).sum(1))
        return np.round(out, DIGITS)

    def first_k(rows, distance, train):
        import numpy as np

        order = np.lexsort((train, distance, rows))
        rows, distance, train = rows[order], distance[order], train[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        keep = place < k
        return rows[keep], distance[keep], train[keep], place[keep]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        import numpy as np

        out = [[np.empty(0, kind.to_pandas_dtype())] for kind in kinds]
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table([pa.array([], kind) for kind in kinds], names=names)
        right = right.sort_by("block")
        tests = _Vectors(left.column("at"), left.column("values"), len(axes))
        points = _Vectors(right.column("at"), right.column("values"), len(axes))
        test_ids, bounds = left.column("test_id"), left.column("bound").to_numpy()
        ids = right.column("ids").combine_chunks()
        starts = ids.offsets.to_numpy()
        copies, flat_ids = np.diff(starts), ids.flatten().to_numpy()
        starts = starts[:-1] - starts[0]
        numbers = right.column("block").to_numpy()
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        blocks = list(zip([0, *cuts], [*cuts, points.n]))
        low, high = (np.empty((len(blocks), axes.shape[1] + 1)) for _ in range(2))
        longest = 0.0
        for b, (begin, end) in enumerate(blocks):
            block = points.rows(np.arange(begin, end))
            shadow = _shadow(block, axes)
            low[b], high[b] = shadow.min(0), shadow.max(0)
            longest = max(longest, float(np.abs(block).max(initial=0)))
        widest = max(end - begin for begin, end in blocks)
        step = max(1, cells // max(widest, len(axes), len(blocks)))
        for start in range(0, tests.n, step):
            some = np.arange(start, min(start + step, tests.n))
            part, bound = tests.rows(some), bounds[some].copy()
            own = _shadow(part, axes)
            gaps = _gaps(own, low, high)
            slack = 1e-6 * (1 + np.sqrt((part * part).sum(1)))  # for the rounding of shadows
            part -= middle
            # Single precision will do to find the few pairs to be worked out exactly.
            kind = np.float32 if max(longest, float(np.abs(part).max(initial=0))) < 1e12 else np.float64
            length = np.sqrt((part * part).sum(1))
            unit = (len(axes) + 16) * 2 * float(np.finfo(kind).eps)
            part = part.astype(kind)
            rows, distance, train = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
            waiting: list = []

            def settle():
                # The K best so far bound what is still to come.
                nonlocal rows, distance, train, waiting
                rows, distance, train = map(np.concatenate, zip((rows, distance, train), *waiting))
                rows, distance, train, place = first_k(rows, distance, train)
                last = place == k - 1
                bound[rows[last]] = np.minimum(bound[rows[last]], distance[last] * (1 + 1e-12) + 2 * rounding)
                waiting = []

            for b in np.argsort(gaps.mean(0), kind="stable"):
                begin, end = blocks[b]
                guests = np.flatnonzero(gaps[:, b] <= (bound + slack) ** 2)
                if not len(guests):
                    continue
                block = points.rows(np.arange(begin, end)) - middle
                half = (block * block).sum(1) / 2
                product = part[guests] @ block.astype(kind).T
                product -= half.astype(kind)
                # Close enough: product - half >= (length^2 - bound^2) / 2, less the rounding.
                far, own_square = bound[guests], length[guests] ** 2
                error = unit * (length[guests] + far) ** 2 + 1e-30
                near = product >= ((own_square - far**2) / 2 - error).astype(kind)[:, None]
                if end - begin > k and np.count_nonzero(near) > 4 * k * len(guests):
                    kth = -np.partition(-product, k - 1, axis=1)[:, k - 1].astype(float)
                    square = np.maximum(own_square - 2 * kth, 0)
                    reach = length[guests] + np.sqrt(square)
                    error = 2 * unit * (reach + np.sqrt(unit) * reach) ** 2 + 1e-30
                    limit = (np.sqrt(square + 2 * error) + 2 * rounding) ** 2
                    near &= product >= ((own_square - limit) / 2 - error).astype(kind)[:, None]
                found, cols = np.nonzero(near)
                found, cols = guests[found], cols + begin
                if not len(found):
                    continue
                apart = exact(tests, points, start + found, cols)
                kept = apart <= bound[found]
                found, cols, apart = found[kept], cols[kept], apart[kept]
                # One row per copy of the point.
                times = copies[cols]
                within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                waiting.append(
                    (np.repeat(found, times), np.repeat(apart, times), flat_ids[np.repeat(starts[cols], times) + within])
                )
                if sum(len(w[0]) for w in waiting) > k * len(part):
                    settle()
            if waiting:
                settle()
            out[0].append(start + rows), out[1].append(train), out[2].append(distance)
        rows, train, distance = map(np.concatenate, out)
        return pa.table(
            [test_ids.take(pa.array(rows, pa.int64())), pa.array(train, kinds[1]), pa.array(distance, kinds[2])],
            names=names,
        )

    return search


def votes(
    neighbors: DataFrame, tags: DataFrame, all_tags: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``test_id, tag, votes``: tags (or first tags) counted over the neighbours.

    ``tags`` holds ``id, tags``. One train post may neighbour very many tests, hence lookup.
    """
    cast = F.col("tags") if all_tags else F.array_compact(F.array(tx.primary_tag(F.col("tags"))))
    ballots = lookup(
        neighbors.select("test_id", F.col("train_id").alias("id")),
        tags.select("id", cast.alias("tags")),
        "id",
        hot_rows=hot_rows,
    )
    return (
        ballots.select("test_id", F.explode("tags").alias("tag"))
        .groupBy("test_id", "tag")
        .agg(F.count("*").alias("votes"))
    )


def predict_tags(ballots: DataFrame, most: int = 3) -> DataFrame:
    """``test_id, tag``: of the ``most`` best tags, those tied with the best."""
    ranked = Window.partitionBy("test_id").orderBy(F.col("votes").desc(), F.col("tag").asc())
    best = F.first("votes").over(ranked)
    return (
        ballots.select("test_id", "tag", "votes", F.row_number().over(ranked).alias("rn"), best.alias("best"))
        .where((F.col("rn") <= most) & (F.col("votes") == F.col("best")))
        .select("test_id", "tag")
    )
