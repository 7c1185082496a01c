"""A damaged copy of the supplied tables: NULLs, orphans, duplicates and a hot key.

The supplied tables have none of these, so a left join looks like an inner one there.
"""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

# Keys that get orphans and one value that a third of the rows share.
KEYS = {
    "customer": ["c_nationkey"],
    "supplier": ["s_nationkey"],
    "nation": ["n_regionkey"],
    "orders": ["o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey"],
}
WORDS = {
    "l_returnflag": "X",
    "o_orderstatus": "X",
    "text": "   ",
    "url": "https://example.com/99999999999999999999/x",
}


def damage(table: pa.Table, name: str, rng: random.Random) -> pa.Table:
    rows = table.num_rows
    repeated = [rng.randrange(rows) for _ in range(max(2, rows // 20))]
    table = table.take([*range(rows), *repeated])
    columns = []
    for field in table.schema:
        values = table[field.name].to_pylist()
        hot = values[0]
        for i in range(len(values)):
            draw = rng.random()
            if field.name in KEYS.get(name, ()) and draw < 1 / 3:
                values[i] = hot
            elif field.name in KEYS.get(name, ()) and draw < 0.4:
                values[i] = 10**6 + rng.randrange(3)
            elif field.name in WORDS and draw < 0.05:
                values[i] = WORDS[field.name]
            elif draw > 0.95:
                values[i] = None
        columns.append(pa.array(values, field.type))
    return pa.table(columns, names=table.schema.names)


def damaged_copy(source: str, target: Path, seed: int) -> str:
    rng = random.Random(seed)
    for file in sorted(Path(source).glob("*.parquet")):
        pq.write_table(damage(pq.read_table(file), file.stem, rng), target / file.name)
    return str(target)
