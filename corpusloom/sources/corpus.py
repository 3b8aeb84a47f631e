"""Multi-folder word-level corpus: one scan over all folders, tagged from the file path."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schemas import CORPUS_FOLDERS, POS_FOLDERS
from corpusloom.sources.files import available, read_word_tsv

_TAGS = "_path string, source string, pos_folder string, split string, source_rank int, pos_rank int"


def _tags(path: str, folders: Sequence[str], pos: Sequence[str]) -> tuple:
    """What the path of a file says about its rows."""
    names = "|".join(map(re.escape, pos))
    found = re.search(r"([^/]+)(?:/(" + names + r"))?/(train|test)\.tsv(?:/[^/]+)?$", path)
    source, pos_folder, split = found.groups() if found else ("", None, "")
    rank = folders.index(source) if source in folders else None
    return source, pos_folder, split, rank, pos.index(pos_folder) if pos_folder in pos else -1


def scan_corpus(
    spark: SparkSession, root: str, folders: Sequence[str] = CORPUS_FOLDERS, pos: Sequence[str] = POS_FOLDERS
) -> DataFrame:
    """Word rows of every ``<folder>[/<pos>]/{train,test}.tsv`` under ``root``, with ``source``, ``pos_folder``,
    ``split`` and the ranks that fix the folder order. Absent folders are skipped."""
    root = root.rstrip("/")
    candidates = {}
    for folder in folders:
        for split in ("train", "test"):
            candidates[f"{folder}/{split}"] = f"{root}/{folder}/{split}.tsv"
            if folder.endswith("_pos"):
                for p in pos:
                    candidates[f"{folder}/{p}/{split}"] = f"{root}/{folder}/{p}/{split}.tsv"
    found = available(spark, candidates)
    if not found:
        raise ValueError(f"no corpus files under {root}")
    words = read_word_tsv(spark, list(found.values())).withColumn("_path", F.input_file_name())
    tags = spark.createDataFrame([(p, *_tags(unquote(p), folders, pos)) for p in words.inputFiles()], _TAGS)
    # looked up by the whole path: taking it apart again for every row would cost more than reading the row
    return words.join(F.broadcast(tags), "_path", "left").drop("_path")
