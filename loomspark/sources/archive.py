"""Archives in volumes: checked by their sums, read as one file, and unpacked member by member, encrypted ones as well.

Members encrypted by the AE-2 scheme of ZIP (AES in counter mode, keys by PBKDF2, an HMAC at the end) are decrypted block by
block. The cipher is that of FIPS 197; where the package `cryptography` is there, it does the work.
"""

from __future__ import annotations

import hashlib
import hmac
import io
import struct
import uuid
import zipfile
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from loomspark.sources import files

#: Fixed values of the formats: the method that stands for encryption, its extra field, rounds of the key derivation, bytes of the HMAC.
ENCRYPTED, EXTRA, DERIVED, TAG = 99, 0x9901, 1000, 10
BLOCK = 1 << 20


class Volumes(io.RawIOBase):
    """Files read one after the other as one, with seek."""

    def __init__(self, paths: list[str]):
        self.paths, self.at, self.open_ = paths, 0, {}
        sizes = [files.info(p).size for p in paths]
        if None in sizes:
            raise FileNotFoundError(paths[sizes.index(None)])
        self.starts = [0, *np.cumsum(sizes).tolist()]

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = offset + (0, self.at, self.starts[-1])[whence]
        return self.at

    def tell(self) -> int:
        return self.at

    def readinto(self, out) -> int:  # noqa: ANN001
        if self.at >= self.starts[-1] or not len(out):
            return 0
        k = bisect_right(self.starts, self.at) - 1
        if k not in self.open_:
            self.open_[k] = files.open_bytes(self.paths[k])
        self.open_[k].seek(self.at - self.starts[k])
        data = self.open_[k].read(min(len(out), self.starts[k + 1] - self.at))
        out[: len(data)] = data
        self.at += len(data)
        return len(data)


def _sbox() -> np.ndarray:
    """The substitution of FIPS 197 by its rule: the inverse in GF(2^8), then the affine map. Powers and logarithms are those of the generator 3."""
    power = [1]
    for _ in range(254):
        x = power[-1]
        power.append(x ^ (x << 1 & 0xFF) ^ (0x1B if x & 0x80 else 0))
    log = {x: i for i, x in enumerate(power)}
    inverse = [0] + [power[-log[x] % 255] for x in range(1, 256)]
    turn = lambda x, k: (x << k | x >> (8 - k)) & 0xFF
    return np.array([x ^ turn(x, 1) ^ turn(x, 2) ^ turn(x, 3) ^ turn(x, 4) ^ 0x63 for x in inverse], np.uint8)


SBOX = _sbox()
TWICE = np.array([x << 1 & 0xFF ^ (0x1B if x & 0x80 else 0) for x in range(256)], np.uint8)
SHIFTED = np.array([4 * ((c + r) % 4) + r for c in range(4) for r in range(4)])


def _round_keys(key: bytes) -> np.ndarray:
    n = len(key) // 4
    words = [np.frombuffer(key[4 * i : 4 * i + 4], np.uint8) for i in range(n)]
    step = 1
    for i in range(n, 4 * (n + 7)):
        w = words[-1]
        if i % n == 0:
            w = SBOX[np.roll(w, -1)] ^ np.array([step, 0, 0, 0], np.uint8)
            step = int(TWICE[step])
        elif n > 6 and i % n == 4:
            w = SBOX[w]
        words.append(words[i - n] ^ w)
    return np.concatenate(words).reshape(-1, 16)


def encrypt_blocks(key: bytes, blocks: np.ndarray) -> np.ndarray:
    """AES of rows of 16 bytes, each for itself."""
    try:
        from cryptography.hazmat.primitives.ciphers import Cipher, algorithms, modes
    except ModuleNotFoundError:
        keys = _round_keys(key)
        state = blocks ^ keys[0]
        for k in keys[1:-1]:
            state = SBOX[state][:, SHIFTED].reshape(-1, 4, 4)
            twice, whole = TWICE[state], np.bitwise_xor.reduce(state, axis=2, keepdims=True)
            state = (state ^ whole ^ twice ^ np.roll(twice, -1, axis=2)).reshape(-1, 16) ^ k
        return SBOX[state][:, SHIFTED] ^ keys[-1]
    return np.frombuffer(Cipher(algorithms.AES(key), modes.ECB()).encryptor().update(blocks.tobytes()), np.uint8).reshape(-1, 16)


def keystream(key: bytes, first: int, n: int) -> np.ndarray:
    """n blocks of the counter mode with little-endian counters, from block number `first` (the first of all is 1)."""
    counters = np.zeros((n, 2), "<u8")
    counters[:, 0] = np.arange(first, first + n, dtype=np.uint64)
    return encrypt_blocks(key, counters.view(np.uint8).reshape(n, 16)).reshape(-1)


def _strength(extra: bytes) -> tuple[int, int] | None:
    """(bytes of the key, the real method) of an encrypted member's extra fields."""
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA and size >= 7:
            return 8 + 8 * extra[at + 8], struct.unpack_from("<H", extra, at + 9)[0]
        at += 4 + size
    return None


def member_bytes(archive: io.BufferedReader, info: zipfile.ZipInfo, password: bytes | None) -> Iterator[bytes]:
    """The content of a member, piece by piece; ValueError for a wrong password, a wrong HMAC or content of another length than the archive names."""
    if info.compress_type != ENCRYPTED:
        with zipfile.ZipFile(archive) as z, z.open(info) as f:
            while piece := f.read(BLOCK):
                yield piece
        return
    found = _strength(info.extra)
    if found is None or password is None:
        raise ValueError(f"{info.filename} is encrypted in a way that can't be read, or there is no password")
    size, method = found
    archive.seek(info.header_offset + 26)
    archive.seek(info.header_offset + 30 + sum(struct.unpack("<HH", archive.read(4))))
    salt, check = archive.read(size // 2), archive.read(2)
    keys = hashlib.pbkdf2_hmac("sha1", password, salt, DERIVED, 2 * size + 2)
    if keys[-2:] != check:
        raise ValueError(f"{info.filename}: wrong password")
    mac, inflate = hmac.new(keys[size : 2 * size], digestmod="sha1"), zlib.decompressobj(-15) if method == 8 else None
    left, block, made = info.compress_size - size // 2 - 2 - TAG, 1, 0
    while left > 0:
        data = archive.read(min(BLOCK, left))
        if not data:
            break
        left -= len(data)
        mac.update(data)
        stream = keystream(keys[:size], block, -(-len(data) // 16))
        block += len(stream) // 16
        piece = (np.frombuffer(data, np.uint8) ^ stream[: len(data)]).tobytes()
        piece = inflate.decompress(piece) if inflate else piece
        made += len(piece)
        yield piece
    rest = inflate.flush() if inflate else b""
    yield rest
    if left or not hmac.compare_digest(mac.digest()[:TAG], archive.read(TAG)) or made + len(rest) != info.file_size:
        raise ValueError(f"{info.filename}: the content is cut or was changed")


def wrong_volumes(spark: SparkSession, volumes: list[str], sums: dict[str, str]) -> DataFrame:
    """(path, sum) of volumes whose SHA-256 isn't the one in `sums` (by the path's last part); a volume that `sums` lacks is wrong, too."""

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            out = []
            for path in b["path"]:
                h = hashlib.sha256()
                with files.open_bytes(path) as f:
                    while data := f.read(BLOCK):
                        h.update(data)
                if sums.get(path.rsplit("/", 1)[-1]) != h.hexdigest():
                    out.append((path, h.hexdigest()))
            yield pd.DataFrame(out, columns=["path", "sum"])

    return spark.createDataFrame([(v,) for v in volumes], "path string").repartition(max(1, len(volumes))).mapInPandas(run, "path string, sum string")


def extract(spark: SparkSession, volumes: list[str], target: str, password: str | None = None) -> DataFrame:
    """Unpack the members of a ZIP archive cut into volumes below `target`; returns (path, size).

    Volumes are read as one file, without joining them; each member is a task's, written whole or not at all, and a wrong
    one is an error. Names that lead out of the target are refused.
    """
    with zipfile.ZipFile(io.BufferedReader(Volumes(volumes))) as z:
        names = [m.filename for m in z.infolist() if not m.is_dir()]
    if bad := [n for n in names if n.startswith("/") or ".." in n.split("/")]:
        raise ValueError(f"{bad[0]} leads out of the target")
    secret = None if password is None else password.encode()

    def run(batches):  # noqa: ANN001, ANN202
        archive = io.BufferedReader(Volumes(volumes), BLOCK)
        members = {m.filename: m for m in zipfile.ZipFile(archive).infolist()}
        for b in batches:
            for name in b["path"]:
                fs, there = files.located(f"{target.rstrip('/')}/{name}")
                fs.create_dir(there.rsplit("/", 1)[0], recursive=True)
                part = f"{there}.{uuid.uuid4().hex}.tmp"
                try:
                    with fs.open_output_stream(part) as f:
                        size = sum(f.write(piece) or len(piece) for piece in member_bytes(archive, members[name], secret))
                except BaseException:
                    fs.delete_file(part)
                    raise
                fs.move(part, there)
                yield pd.DataFrame([(name, size)], columns=["path", "size"])

    return spark.createDataFrame([(n,) for n in names], "path string").repartition(min(max(1, len(names)), 4096)).mapInPandas(run, "path string, size bigint")
