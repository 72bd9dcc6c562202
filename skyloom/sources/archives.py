"""Monthly zip archives, each holding one CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Year and month end the name, alone or after another underscore.
ARCHIVE_NAME = r"(?:^|[_/])(\d+)_(\d+)\.[^/]*$"


def scan_archives(spark: SparkSession, path: str, with_content: bool = False) -> DataFrame:
    """The zip files below ``path``: their paths and lengths, and on request their ``content``.

    Without the content nothing but the listing is read; tasks open the paths. The content,
    2 GB an archive at most, is for file systems that tasks cannot open.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return files.select("path", "length", *(["content"] if with_content else []))


def _open(path: str):
    """A file that can be read anywhere in it, without loading it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        path = "file:///" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    system, name = fs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def extract_lines(archives: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """Unzip on the executors: ``line`` with ``file_year`` and ``file_month`` of the archive name.

    A zip stream can only be read from its start, so one archive is the unit of
    work. The task opens the path, or the ``content`` column if there is one, inflates block by
    block and lets lines leave in batches; neither the archive nor its text is held as a whole. An
    archive without exactly one CSV file stops the job.
    """
    batch_lines = 20_000
    held = "content" in archives.columns

    def unzip(batches):
        import io
        import zipfile
        from itertools import islice

        import pandas as pd

        for batch in batches:
            for path, year, month, content in zip(
                batch["path"], batch["file_year"], batch["file_month"], batch["content" if held else "path"]
            ):
                source = io.BytesIO(content) if held else _open(path)
                with source, zipfile.ZipFile(source) as archive:
                    members = [
                        n for n in archive.namelist() if n.endswith(".csv") and "/" not in n
                    ]
                    if len(members) != 1:
                        raise ValueError(f"{path}: expected one CSV file, found {len(members)}")
                    with archive.open(members[0]) as raw:
                        text = io.TextIOWrapper(raw, encoding=encoding, newline="\n")
                        while lines := [s.rstrip("\r\n") for s in islice(text, batch_lines)]:
                            yield pd.DataFrame(
                                {"file_year": year, "file_month": month, "line": lines}
                            )

    named = archives.select(
        "path",
        F.regexp_extract("path", ARCHIVE_NAME, 1).try_cast("int").alias("file_year"),
        F.regexp_extract("path", ARCHIVE_NAME, 2).try_cast("int").alias("file_month"),
        *(["content"] if held else []),
    )
    checked = named.withColumn(
        "file_year",
        F.when(F.col("file_month").isNull(), F.raise_error(F.concat(F.lit("no month: "), "path")))
        .otherwise(F.col("file_year"))
        .cast("int"),
    )
    return checked.mapInPandas(unzip, "file_year int, file_month int, line string")


def write_extracted(lines: DataFrame, path: str) -> None:
    """Text files below ``file_year=/file_month=``, so that later scans prune by month.

    Months that ``lines`` holds are replaced, all others stay.

    The folder names differ from the raw columns ``Year`` and ``Month``, which a
    folder column of the same name would replace on reading.
    """
    (
        lines.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_year", "file_month")
        .text(path)
    )
