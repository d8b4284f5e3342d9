"""Search services as a data source over captured answers: spark.read.format("captured").

Options: path (a folder with <platform>/<name>.json, each the whole answer of one search), platform. Rows: (platform, name, item), one per
item of the answer, whose place in it differs by service. A call over the network is no part of the engine; a capture holds what it gave.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Where the items of an answer are.
ITEMS = {"bluesky": ("posts",), "youtube": ("items",), "hackernews": ("hits",), "hnjobs": ("hits",), "github": ("items",), "reddit": ("data", "children")}


def items_of(platform: str, answer: dict) -> list:
    v = answer
    for k in ITEMS[platform]:
        v = v.get(k, {}) if isinstance(v, dict) else {}
    found = v if isinstance(v, list) else []
    return [x.get("data", {}) if platform == "reddit" and isinstance(x, dict) else x for x in found]


class Captured(DataSource):
    @classmethod
    def name(cls) -> str:
        return "captured"

    def schema(self) -> str:
        return "platform string, name string, item string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.root, self.platforms = Path(options["path"]), [options["platform"]] if options.get("platform") else list(ITEMS)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((p, str(f))) for p in self.platforms for f in sorted((self.root / p).glob("*.json"))] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        platform, path = partition.value
        try:
            answer = json.loads(Path(path).read_text(encoding="utf-8"))
        except (OSError, ValueError):
            return  # a search that failed is made up for by the next run
        for x in items_of(platform, answer if isinstance(answer, dict) else {}):
            yield platform, Path(path).stem, json.dumps(x, ensure_ascii=False)
