import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fleetlake.session import build_session
    ckpt = tempfile.mkdtemp(prefix="fleetlake-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": tempfile.mkdtemp()})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="fleetlake-test-")


PING_DDL = ("ID_Bus string, Ruta string, Velocidad_kmh double, Latitud double, Longitud double, "
            "Timestamp timestamp_ntz")


def ping(bus="BUS_1", route="210", speed=20.0, lat=-33.45, lon=-70.66, ts="2024-01-05 10:00:00"):
    import datetime as dt
    t = dt.datetime.fromisoformat(ts) if isinstance(ts, str) else ts
    return (bus, route, speed, lat, lon, t)
