import hashlib
import hmac
import random
import struct
import zipfile
import zlib

import numpy as np
import pytest

from loomspark.sources import archive


def test_cipher_by_the_standard():
    """The examples of FIPS 197, appendix C."""
    plain = np.frombuffer(bytes.fromhex("00112233445566778899aabbccddeeff"), np.uint8).reshape(1, 16)
    for n, want in ((16, "69c4e0d86a7b0430d8cdb78070b4c55a"), (24, "dda97ca4864cdfe06eaf70a0ec0d7191"), (32, "8ea2b7ca516745bfeafc49904b496089")):
        assert archive.encrypt_blocks(bytes(range(n)), plain).tobytes().hex() == want


def sealed(path, members, password):
    """A ZIP file with encrypted members (256 bits), made by the format's description."""
    body, directory = b"", b""
    for k, (name, content, method) in enumerate(members):
        salt = bytes([k] * 16)
        keys = hashlib.pbkdf2_hmac("sha1", password, salt, 1000, 66)
        packed = content
        if method == 8:
            c = zlib.compressobj(9, zlib.DEFLATED, -15)
            packed = c.compress(content) + c.flush()
        stream = archive.keystream(keys[:32], 1, -(-len(packed) // 16) or 1)
        secret = (np.frombuffer(packed, np.uint8) ^ stream[: len(packed)]).tobytes()
        data = salt + keys[64:] + secret + hmac.new(keys[32:64], secret, "sha1").digest()[:10]
        extra = struct.pack("<HHH2sBH", 0x9901, 7, 2, b"AE", 3, method)
        sizes = (0, len(data), len(content), len(name), len(extra))
        directory += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 51, 51, 1, 99, 0, 0, *sizes, 0, 0, 0, 0, len(body)) + name.encode() + extra
        body += struct.pack("<IHHHHHIIIHH", 0x04034B50, 51, 1, 99, 0, 0, *sizes) + name.encode() + extra + data
    path.write_bytes(body + directory + struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, len(members), len(members), len(directory), len(body), 0))


def cut(path, n):
    data = path.read_bytes()
    step = -(-len(data) // n)
    out = []
    for i in range(n):
        out.append(path.with_name(f"{path.name}.{i:03d}"))
        out[-1].write_bytes(data[i * step : (i + 1) * step])
    return [str(p) for p in out]


def test_encrypted_members_in_volumes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "BLOCK", 1 << 12)
    rng = random.Random(3)
    members = [("a.parquet", rng.randbytes(50_000), 0), ("deep/b.txt", b"the gate " * 9000, 8), ("empty", b"", 0), ("short", b"x", 8)]
    sealed(tmp_path / "x.zip", members, b"secret")
    volumes = cut(tmp_path / "x.zip", 5)
    got = archive.extract(spark, volumes, str(tmp_path / "out"), "secret")
    assert sorted(map(tuple, got.collect())) == sorted((n, len(c)) for n, c, _ in members)
    assert all((tmp_path / "out" / n).read_bytes() == c for n, c, _ in members)
    for password in ("wrong", None):
        with pytest.raises(Exception, match="password"):
            archive.extract(spark, volumes, str(tmp_path / "no"), password).collect()
    data = bytearray((tmp_path / "x.zip").read_bytes())
    data[1000] ^= 1
    (tmp_path / "y.zip").write_bytes(data)
    with pytest.raises(Exception, match="cut or was changed"):
        archive.extract(spark, [str(tmp_path / "y.zip")], str(tmp_path / "no"), "secret").collect()
    assert not (tmp_path / "no" / "a.parquet").exists()


def test_plain_archive_and_sums(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "p.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a/x.txt", "hello " * 500)
        z.writestr("y.txt", "")
    volumes = cut(tmp_path / "p.zip", 3)
    assert sorted(map(tuple, archive.extract(spark, volumes, str(tmp_path / "out")).collect())) == [("a/x.txt", 3000), ("y.txt", 0)]
    sums = {v.rsplit("/", 1)[-1]: hashlib.sha256(open(v, "rb").read()).hexdigest() for v in volumes}
    assert archive.wrong_volumes(spark, volumes, sums).count() == 0
    sums["p.zip.001"] = "0"
    del sums["p.zip.002"]
    assert sorted(r.path[-3:] for r in archive.wrong_volumes(spark, volumes, sums).collect()) == ["001", "002"]
    with zipfile.ZipFile(tmp_path / "q.zip", "w") as z:
        z.writestr("../evil", "x")
    with pytest.raises(ValueError, match="leads out"):
        archive.extract(spark, [str(tmp_path / "q.zip")], str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        archive.extract(spark, [str(tmp_path / "gone")], str(tmp_path / "out"))
