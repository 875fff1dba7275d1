"""A stream from sockets: messages, a line each, pulled from any number of producers that listen on ports."""

from __future__ import annotations

import select
import socket
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..operators.sharding import consumers

#: Messages of a batch at most: what is beyond waits at the producers, whose sends then block.
QUEUE = 10_000


class PortReader(SimpleDataSourceStreamReader):
    """Pulls from all ports in turn, so that a slow producer holds up no other.

    An offset is the number of messages so far. Those of batches that aren't committed yet are kept, so that a batch
    that fails is given again as it was; a producer sends each message once, to one consumer.
    """

    def __init__(self, host: str, ports: list[int], wait: float, queue: int):
        self.host, self.ports, self.wait, self.queue = host, ports, wait, queue
        self.open: dict[socket.socket, bytes] | None = None
        self.held: dict[int, str] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {"n": 0}

    def _pull(self) -> Iterator[str]:
        if self.open is None:
            self.open = {socket.create_connection((self.host, p), timeout=10): b"" for p in self.ports}
        ends = time.monotonic() + self.wait
        taken = 0
        while self.open and taken < self.queue and time.monotonic() < ends:
            for s in select.select(list(self.open), [], [], max(0.0, ends - time.monotonic()))[0]:
                data = s.recv(1 << 16)
                *lines, rest = (self.open[s] + data).split(b"\n")
                for line in lines:
                    taken += 1
                    yield line.decode()
                self.open[s] = rest
                if not data:
                    s.close()
                    del self.open[s]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        n = start["n"]
        for message in self._pull():
            self.held[n] = message
            n += 1
        return self.readBetweenOffsets(start, {"n": n}), {"n": n}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802
        return iter([(self.held[i],) for i in range(start["n"], end["n"])])

    def commit(self, end: dict) -> None:
        self.held = {i: m for i, m in self.held.items() if i >= end["n"]}


class PortSource(DataSource):
    """``spark.readStream.format("framewright-ports").option("ports", "5000,5001").load()``: rows of (message)."""

    @classmethod
    def name(cls) -> str:
        return "framewright-ports"

    def schema(self) -> str:
        return "message string"

    def simpleStreamReader(self, schema) -> PortReader:  # noqa: N802
        ports = [int(p) for p in self.options["ports"].split(",")]
        return PortReader(self.options.get("host", "127.0.0.1"), ports, float(self.options.get("wait", "1")), int(self.options.get("queue", QUEUE)))


def read_ports(spark: SparkSession, ports: list[int], host: str = "127.0.0.1", workers: int | None = None, **options) -> DataFrame:
    """The stream of messages; with `workers` each goes to one of so many tasks."""
    spark.dataSource.register(PortSource)
    stream = spark.readStream.format("framewright-ports").option("ports", ",".join(map(str, ports))).option("host", host)
    for name, value in options.items():
        stream = stream.option(name, value)
    return consumers(stream.load(), workers, "message").drop("consumer") if workers else stream.load()
