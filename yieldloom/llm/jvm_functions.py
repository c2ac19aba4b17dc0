"""Functions for Spark SQL from Java source, compiled by the compiler that Spark has for its own generated code.

The classes travel to the executors in a jar that the session adds, so that nothing has to be installed or built.
"""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.types import DataType

_JARS: dict[str, str] = {}


@cache
def _folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="yieldloom-jars-", dir=Path(tempfile.gettempdir()).resolve())


def _jar(spark: SparkSession, package: str, source: str, resources: dict[str, bytes]) -> str:
    compiler = spark._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.cook(source)
    jar = Path(_folder().name) / f"{package}.jar"
    with zipfile.ZipFile(jar, "w") as out:
        for name, code in dict(compiler.getBytecodes()).items():
            out.writestr(name.replace(".", "/") + ".class", bytes(code))
        for name, content in resources.items():
            out.writestr(f"{package}/{name}", content)
    return str(jar)


def registered(spark: SparkSession, source: Path, resources: dict[str, bytes], functions: dict[str, DataType]) -> dict[str, str]:
    """Registers nested classes of the source's class and returns the functions' names. The package is named by what is
    in it, so that jars of several resources and versions stand side by side."""
    text = source.read_text(encoding="utf-8")
    digest = hashlib.sha256(text.encode())
    for name in sorted(resources):
        digest.update(name.encode() + b"\0" + hashlib.sha256(resources[name]).digest())
    package = f"yieldloom_{digest.hexdigest()[:16]}"
    if not Path(_JARS.get(package, "")).is_file():
        _JARS[package] = _jar(spark, package, text.replace("package yieldloom;", f"package {package};", 1), resources)
    names = {function: f"{package}_{function}" for function in functions}
    if all(map(spark.catalog.functionExists, names.values())):
        return names
    spark.sql(f"ADD JAR '{_JARS[package]}'")
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    urls = array(jvm.java.net.URL, 1)
    urls[0] = jvm.java.io.File(_JARS[package]).toURI().toURL()
    loader = jvm.java.net.URLClassLoader(urls, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    for function, returns in functions.items():
        made = loader.loadClass(f"{package}.{source.stem}${function}").getConstructor(array(jvm.java.lang.Class, 0)).newInstance(array(jvm.java.lang.Object, 0))
        spark._jsparkSession.udf().register(names[function], made, spark._jsparkSession.parseDataType(returns.json()))
    return names
