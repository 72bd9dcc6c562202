"""Zip archives built from lines, as input for the archive reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.schemas import RAW_COLUMNS


def pack_lines(lines: DataFrame) -> DataFrame:
    """Lines to archives ``path, content``: one per month and batch of rows of a task.

    Each archive holds one CSV file with a header line. A month with many rows
    becomes many archives, so nothing is grouped.
    """
    header = ",".join(RAW_COLUMNS)

    def pack(batches):
        import io
        import zipfile

        import pandas as pd
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            for (year, month), rows in batch.groupby(["year", "month"]):
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr("flights.csv", "\n".join([header, *rows["line"], ""]))
                yield pd.DataFrame(
                    {
                        "path": [f"part{part}-{number}_{year}_{month}.zip"],
                        "content": [packed.getvalue()],
                    }
                )

    date = F.from_csv("line", "_1 string, _2 string, _3 string, _4 string, _5 string, date string")
    dated = lines.select(
        F.year(date["date"].cast("date")).alias("year"),
        F.month(date["date"].cast("date")).alias("month"),
        "line",
    )
    return dated.mapInPandas(pack, "path string, content binary")


def write_archives(archives: DataFrame, folder: str) -> None:
    """Each archive as a file of its own in a folder that tasks reach by a path or URI."""

    def write(batches):
        from pyarrow import fs

        uri = folder if ":" in folder else f"file://{folder}"
        uri = "file:///" + uri[5:].lstrip("/") if uri.startswith("file:") else uri
        system, base = fs.FileSystem.from_uri(uri)
        system.create_dir(base, recursive=True)
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                with system.open_output_stream(f"{base}/{path}") as out:
                    out.write(content)
            yield batch[["path"]]

    archives.mapInPandas(write, "path string").write.format("noop").mode("overwrite").save()
