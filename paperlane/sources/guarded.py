"""Parsers in a child process that can be stopped: a file that hangs in native code or eats memory costs its own row, never the task.

A task has one child, forked at its first file. A file's bytes go to it through a pipe and its answer comes back; a child that misses the
deadline or dies is killed and forked anew for the next file. Memory is limited by the system, on top of what the
worker held when the child was forked.
"""

from __future__ import annotations

import os
import pickle
import signal
from collections.abc import Callable
from multiprocessing.connection import Connection, Pipe


class Died(RuntimeError):
    """The child ended without an answer: killed by the system, or by an error in native code."""


def _limit_memory(megabytes: int) -> None:
    import resource

    with open("/proc/self/statm", encoding="ascii") as f:
        held = int(f.read().split()[0]) * resource.getpagesize()
    most = held + (megabytes << 20)
    _, hard = resource.getrlimit(resource.RLIMIT_AS)
    resource.setrlimit(resource.RLIMIT_AS, (most if hard == resource.RLIM_INFINITY else min(most, hard), hard))


class Guard:
    """``call(data, header)`` in a child; use as a context, so the child ends with the task.

    TimeoutError after ``seconds``; Died if the child is gone; RuntimeError with the name of what ``call`` raised as its only
    argument. Without fork (no POSIX system) the call is made here, without limits.
    """

    def __init__(self, call: Callable[[bytes, object], object], seconds: float, megabytes: int = 0):
        self.call, self.seconds, self.megabytes = call, seconds, megabytes
        self.pid, self.pipe = 0, None

    def __enter__(self) -> Guard:
        return self

    def __exit__(self, *_: object) -> None:
        self._end()

    def _end(self) -> None:
        if self.pid:
            self.pipe.close()
            try:
                os.kill(self.pid, signal.SIGKILL)
                os.waitpid(self.pid, 0)
            except (ProcessLookupError, ChildProcessError):
                pass
            self.pid, self.pipe = 0, None

    def _begin(self) -> None:
        self.pipe, theirs = Pipe()
        self.pid = os.fork()
        if self.pid == 0:
            self.pipe.close()
            try:
                self._serve(theirs)
            finally:
                os._exit(0)
        theirs.close()

    def _serve(self, pipe: Connection) -> None:
        for s in (signal.SIGTERM, signal.SIGALRM):
            signal.signal(s, signal.SIG_DFL)
        if self.megabytes:
            try:
                _limit_memory(self.megabytes)
            except (ImportError, OSError, ValueError):
                pass  # the deadline still holds
        while True:
            try:
                header = pickle.loads(pipe.recv_bytes())
                data = pipe.recv_bytes()
            except EOFError:
                return  # the task has ended
            except MemoryError:
                return
            try:
                answer = ("ok", self.call(data, header))
            except BaseException as e:
                answer = ("error", type(e).__name__)
            del data
            try:
                pipe.send_bytes(pickle.dumps(answer, protocol=5))
            except MemoryError:
                pipe.send_bytes(pickle.dumps(("error", "MemoryError")))

    def __call__(self, data: bytes, header: object) -> object:
        if not hasattr(os, "fork"):
            return self.call(data, header)
        if not self.pid:
            self._begin()
        try:
            self.pipe.send_bytes(pickle.dumps(header))
            self.pipe.send_bytes(data)
            if not self.pipe.poll(self.seconds if self.seconds > 0 else None):
                raise TimeoutError
            kind, value = pickle.loads(self.pipe.recv_bytes())
        except TimeoutError:
            self._end()
            raise
        except (EOFError, OSError) as e:
            self._end()
            raise Died(type(e).__name__) from None
        if kind == "error":
            raise RuntimeError(value)
        return value
