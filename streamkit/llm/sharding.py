"""Resharding that moves the fewest bytes.

Documents lie in old shards, each cut by hash into files and blocks.  Given
the block sizes and the new shards' capacities (equal), a minimum-cost flow
from old to new shards says how many bytes go where: staying costs nothing,
moving a byte costs one (or what ``cost`` says).  Each arc's flow is made up of
whole blocks, file after file, so that few files are touched; then single
blocks are exchanged until the sizes are near equal.  Only files that hold a
moved block are rewritten, the others stay in place.

Files and blocks follow the table's bytes.  The driver sees one row per block,
of ``FILE`` / ``SPLIT`` bytes or less each on average."""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from streamkit.llm.registry import fresh_dir, query, saved, table

OLD, NEW = 32, 40
FILES, FILE = 8, 32 << 20  # files of a shard at least, and text bytes of a file
BLOCKS, SPLIT = 512, 8  # blocks of a shard at least, and of a file


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """flow[i][j] of least cost that sends all supply, by shortest augmenting
    paths with residual arcs; sum(demand) is at least sum(supply)."""
    n, m = len(supply), len(demand)
    flow = [[0] * m for _ in range(n)]
    left, room = supply[:], demand[:]
    inf = float("inf")
    while any(left):
        dist = [0 if x else inf for x in left] + [inf] * m
        back = [-1] * (n + m)
        changed = True
        while changed:  # Bellman-Ford over n + m nodes
            changed = False
            for i in range(n):
                for j in range(m):
                    if dist[i] + cost[i][j] < dist[n + j]:
                        dist[n + j], back[n + j], changed = dist[i] + cost[i][j], i, True
                    if flow[i][j] and dist[n + j] - cost[i][j] < dist[i]:
                        dist[i], back[i], changed = dist[n + j] - cost[i][j], n + j, True
        end = min((j for j in range(m) if room[j]), key=lambda j: dist[n + j])
        path, node = [], n + end
        while back[node] >= 0:
            path.append((back[node], node))
            node = back[node]
        amount = min([left[node], room[end], *(flow[b][a - n] for a, b in path if a >= n)])
        for a, b in path:
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[node] -= amount
        room[end] -= amount
    return flow


def plan(blocks: list[tuple[int, int, int]], old: int, new: int, cost: list[list[int]] | None = None, per_file: int = BLOCKS // FILES) -> dict[tuple[int, int], int]:
    """(old shard, block) -> new shard, from (old shard, block, bytes); the sizes
    of the new shards come out near equal and few bytes move.  ``per_file``
    neighbouring blocks lie in a file."""
    total = sum(x[2] for x in blocks)
    goal = [total * (j + 1) // new - total * j // new for j in range(new)]
    have = [0] * old
    for s, _, n in blocks:
        have[s] += n
    cost = cost or [[int(i != j) for j in range(new)] for i in range(old)]
    flow = min_cost_flow(have, goal, cost)
    to: dict[tuple[int, int], int] = {}
    sizes = {(s, b): n for s, b, n in blocks}
    fill = [0] * new
    of: list[list[tuple[int, int]]] = [[] for _ in range(old)]
    for s, b, n in blocks:
        of[s].append((b, n))
    for s in range(old):
        need = {j: x for j, x in enumerate(flow[s]) if x and j != s}
        mine = sorted(((b // per_file, n, b) for b, n in of[s]), reverse=True)
        for _, n, b in mine:
            j = max(need, key=need.get, default=None)
            home = s < new and flow[s][s] > 0
            if j is not None and (need[j] >= n or not home):
                need[j] -= n
                to[s, b] = j
            else:
                to[s, b] = s if home else max(range(new), key=lambda k: goal[k] - fill[k])
            fill[to[s, b]] += n
    held: list[list[tuple[int, tuple[int, int]]]] = [[] for _ in range(new)]
    for key, j in to.items():
        bisect.insort(held[j], (sizes[key], key))
    while True:  # each step lets the sum of squared sizes fall, so they end
        step = None
        for high, low in ((i, j) for i in sorted(range(new), key=fill.__getitem__, reverse=True) for j in sorted(range(new), key=fill.__getitem__)):
            gap = fill[high] - fill[low]
            if gap > 1:
                step = min(((abs(gap - 2 * (x[0] - y[0])), x, y) for x in held[high] for y in _around(held[low], x[0] - gap // 2) if 0 < x[0] - y[0] < gap),
                           default=None, key=lambda t: t[0])
            if step is not None:
                break
        if step is None:
            break
        for x, a, b in ((step[1], high, low), (step[2], low, high)):
            if x[1] is not None:
                held[a].remove(x)
                bisect.insort(held[b], x)
                fill[a] -= x[0]
                fill[b] += x[0]
                to[x[1]] = b
    return to


def _around(held: list, size: int) -> list:
    """Nothing (size 0), or the held blocks nearest to ``size``."""
    at = bisect.bisect_left(held, (size, (-1, -1)))
    return [(0, None)] + held[max(0, at - 1):at + 1]


def reshard(docs: DataFrame, *, old: int = OLD, new: int = NEW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lays ``docs`` out in ``old`` shards of files below the shared folder, plans
    and carries out the move to ``new`` shards, and returns per row: (doc_id,
    size, text_crc32, shard, slot, moved, row), read from the new layout; ``row``
    is the whole input row.

    size is the text's UTF-8 bytes (null: none) plus 16.  Slots are gapless from 0
    in each shard.  Rows with a null id are spread by their text; rows that repeat
    an id share a block, in a fixed order.  Input columns of any name are kept
    inside ``row``; an empty table gives an empty one."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(F.xxhash64(F.lit("id"), F.col(id_col).cast("long")), F.lit(0))
    key = F.when(F.col(id_col).isNull(), F.xxhash64(text)).otherwise(key)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    files = max(FILES, -(-total // (old * FILE)))
    per_file = max(SPLIT, -(-BLOCKS // files))
    block = F.pmod(F.shiftright("key", 20), F.lit(files * per_file))
    rows = rows.withColumn("home", F.pmod("key", F.lit(old)).cast("int")).withColumn("block", block.cast("int")).drop("key") \
        .withColumn("file", (F.col("home") * files + F.floor(F.col("block") / per_file)).cast("int"))
    path = fresh_dir(spark, "shards-old")
    rows.repartition(old * files, "file").write.partitionBy("file").parquet(path)
    layout = spark.read.schema(rows.select(*[c for c in rows.columns if c != "file"], "file").schema).parquet(path)

    sums = layout.groupBy("home", "block").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()  # a row per block
    to = plan([(r["home"], r["block"], r["n"]) for r in sums], old, new, per_file=per_file)
    base, at = {}, [0] * new
    for r in sorted(sums, key=lambda r: (r["home"], r["block"])):
        j = to[r["home"], r["block"]]
        base[r["home"], r["block"]], at[j] = at[j], at[j] + r["rows"]
    moves = spark.createDataFrame([(s, b, j, base[s, b]) for (s, b), j in to.items()], "home int, block int, shard int, base long")
    touched = sorted({s * files + b // per_file for (s, b), j in to.items() if j != s})
    changed = F.col("file").isin(touched) if touched else F.lit(False)
    fresh = fresh_dir(spark, "shards-new")
    layout.where(changed).join(F.broadcast(moves.drop("base")), ["home", "block"]).repartition(max(1, 2 * len(touched)), "shard", "file") \
        .write.partitionBy("shard").parquet(fresh)
    again = spark.read.schema(layout.withColumn("shard", F.lit(0)).schema).parquet(fresh).drop("shard") if touched else layout.where(F.lit(False))
    now = layout.where(~changed).unionByName(again).join(F.broadcast(moves), ["home", "block"])
    in_block = F.row_number().over(W.partitionBy("home", "block").orderBy("doc_id", "text_crc32", "size")) - 1
    return now.withColumn("slot", F.col("base") + in_block) \
        .select("doc_id", "size", "text_crc32", "shard", "slot", (F.col("home") != F.col("shard")).alias("moved"), "row")


@query("op6_min_cost_reshard")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "moved")
