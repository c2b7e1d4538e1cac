"""Small files in the shared folder, through the file systems that Spark knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


class SharedFolder:
    """A folder of small texts that only the driver reads and writes.

    ``put_new`` never replaces a file: the text is written aside and renamed, and of several
    writers one alone succeeds. The file system has to have such a rename, as HDFS has.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = path
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of the files; none if the folder is not there yet."""
        if not self._fs.exists(self._at("")):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at("")))

    def read(self, name: str) -> str | None:
        """The text of a file, or None if it is not there."""
        try:
            stream = self._fs.open(self._at(name))
        except Exception as error:
            if "FileNotFoundException" in str(error):
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, name: str, text: str) -> bool:
        """Write a file that is not there yet; False if another writer was first."""
        aside = self._at(f".{name}-{self._jvm.java.util.UUID.randomUUID()}")
        stream = self._fs.create(aside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target = self._at(name)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self._conf
        )
        # No option: an existing target is an error.
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(
                self._fs.makeQualified(aside),
                self._fs.makeQualified(target),
                self._gateway.new_array(kind, 0),
            )
        except Exception as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            self._fs.delete(aside, False)
            return False
        return True

    def delete(self, name: str) -> None:
        """Remove a file or folder; nothing happens if it is gone."""
        self._fs.delete(self._at(name), True)
