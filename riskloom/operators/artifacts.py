"""Model artifacts on shared storage: read and written through Spark's file systems, checked on both ways."""

import json
import uuid

from pyspark.sql import SparkSession

from riskloom.config import PUBLISHED_ARTIFACT, Artifact

# Fixed value: the layout of the document that this library reads.
ARTIFACT_VERSION = PUBLISHED_ARTIFACT["artifact_version"]


def checked(document: dict) -> Artifact:
    """The artifact of a document, or a ValueError that says what is wrong with it."""
    if not isinstance(document, dict):
        raise ValueError("an artifact is a JSON object")
    version = document.get("artifact_version")
    if version != ARTIFACT_VERSION:
        raise ValueError(f"artifact version {version!r}, expected {ARTIFACT_VERSION}")
    try:
        return Artifact.from_dict(document)
    except KeyError as missing:
        raise ValueError(f"artifact without {missing.args[0]}") from missing
    except TypeError as wrong:
        raise ValueError(f"artifact with a value of the wrong type: {wrong}") from wrong


def save_artifact(spark: SparkSession, document: dict, path: str) -> None:
    """Checks the document and writes it with sorted keys; readers see the old one or all of the new one."""
    checked(document)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    target = paths(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    draft = paths(f"{path}.{uuid.uuid4().hex}")
    out = system.create(draft, True)
    try:
        out.write(bytearray(json.dumps(document, indent=2, sort_keys=True) + "\n", "utf-8"))
    finally:
        out.close()
    if system.exists(target):
        system.delete(target, False)
    if not system.rename(draft, target):
        raise OSError(f"cannot move the artifact to {path}")


def load_artifact(spark: SparkSession, path: str) -> Artifact:
    """The artifact at `path`, wherever Spark can read; a ValueError where it breaks the contract."""
    text = spark.read.text(path, wholetext=True).first()
    try:
        document = json.loads(text[0] if text else "")
    except json.JSONDecodeError as broken:
        raise ValueError(f"artifact is not JSON: {broken}") from broken
    return checked(document)
