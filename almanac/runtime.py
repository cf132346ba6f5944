"""What the package needs from a session: its code on the executors, and folders that all of them share."""

from __future__ import annotations

import atexit
import contextlib
import gc
import os
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_folders: list[tuple[SparkSession, str]] = []
#: Bytes of rows that a Python worker is given at once, unless the session asks for fewer: long documents count by size.
BATCH_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, so their workers import it wherever they run, and bounds their batches."""
    context = spark.sparkContext
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:  # not set by the user
        spark.conf.set(name, str(BATCH_BYTES))
    if context.applicationId in _shipped:
        return
    home = Path(__file__).resolve().parent
    path = Path(os.path.realpath(tempfile.mkdtemp(prefix="almanac-code-"))) / "almanac.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f"{home.name}/{f.relative_to(home)}")
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, one is made if all runs on this machine; a cluster is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="almanac-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, which goes when the application ends."""
    path = f"{shared_dir(spark)}/almanac-{name}-{uuid.uuid4().hex[:12]}"

    _folders.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder wherever Spark can reach it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Seconds from one giving back to the next, at least.
GIVE_BACK_S = 4.0
#: When it was last done, and how often the C library was asked too.
_gave_back = [0.0, 0]


def _filled(array, values: tuple):
    for i, v in enumerate(values):
        array[i] = v
    return array


def give_back(spark: SparkSession) -> None:
    """Frees what the driver holds of finished jobs: their broadcasts and shuffles go when its garbage is collected, and what its
    C library keeps of freed memory (of compilers, codecs, ended threads) goes back to the system, where the JVM has a command for that."""
    if time.monotonic() - _gave_back[0] < GIVE_BACK_S:
        return
    jvm = spark.sparkContext._jvm
    gc.collect(0)  # handles of JVM objects
    jvm.System.gc()
    with contextlib.suppress(Exception):  # since JDK 17.0.9, on Linux
        array = lambda kind, *values: _filled(spark.sparkContext._gateway.new_array(kind, len(values)), values)
        lang, name = jvm.java.lang, jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        # by reflection: the server's own class is not open to callers
        of = [lang.Class.forName(c) for c in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")]
        run = lang.Class.forName("javax.management.MBeanServer").getMethod("invoke", array(lang.Class, *of))
        run.invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), array(lang.Object, name, "systemTrimNativeHeap", array(lang.Object), array(lang.String)))
        _gave_back[1] += 1
    _gave_back[0] = time.monotonic()


@atexit.register
def _drop_folders() -> None:
    for spark, path in _folders:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            delete(spark, path)
