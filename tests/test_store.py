"""The model store under writers that stop, overlap and republish."""

import os
import tempfile
import threading
from dataclasses import replace

import pytest

from tidemark import sinks
from tidemark.plans.models import ModelBundle, fixed_models
from tidemark.sinks.store import Store


@pytest.fixture()
def store(spark):
    return Store(spark, os.path.join(tempfile.mkdtemp(prefix="tidemark-store-"), "models"))


def bundle(x):
    b = fixed_models()
    return replace(b, bgnbd=replace(b.bgnbd, r=float(x)), cox=replace(b.cox, baseline=((30.0, x / 10),)), config={"xdays": int(x)})


def whole(b):
    """All parts of a bundle belong to the same version."""
    x = b.config["xdays"]
    assert b.bgnbd.r == x and b.cox.baseline == ((30.0, x / 10),)
    return x


def test_publish_load_and_earlier_numbers(spark, store):
    assert store.current() is None and store.load().bgnbd is None
    for x in (1, 2, 3):
        store.publish(bundle(x), keep=2)
    assert whole(store.load()) == 3 and store.numbers() == [2, 3] and whole(store.load(2)) == 2
    assert len(os.listdir(os.path.join(store.path, "versions"))) == 2


def test_a_reader_between_any_two_writes_sees_one_version(spark, store, monkeypatch):
    """The writer stops before each of its writes in turn."""
    store.publish(bundle(1))
    from pyspark.sql import DataFrameWriter
    writes = {"left": 0}
    plain = {k: getattr(DataFrameWriter, k) for k in ("json", "parquet", "text")}

    class Stopped(Exception):
        pass

    def stopping(kind):
        def write(self, *a, **k):
            if writes["left"] == 0:
                raise Stopped
            writes["left"] -= 1
            return plain[kind](self, *a, **k)
        return write

    for kind in plain:
        monkeypatch.setattr(DataFrameWriter, kind, stopping(kind))
    for done in range(3):
        writes["left"] = done
        with pytest.raises(Stopped):
            store.publish(bundle(2))
        assert whole(store.load()) == 1
    writes["left"] = 99
    with monkeypatch.context() as m:
        m.setattr(Store, "_point", lambda self, n, v: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            store.publish(bundle(2))
    assert whole(store.load()) == 1
    store.publish(bundle(2))
    assert whole(store.load()) == 2


def test_writers_at_the_same_time_get_numbers_of_their_own(spark, store):
    failed = []

    def write(x):
        try:
            Store(spark, store.path).publish(bundle(x), keep=10)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(x,)) for x in (1, 2, 3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and len(store.numbers()) == 3
    assert sorted(whole(store.load(n)) for n in store.numbers()) == [1, 2, 3]


def test_a_taken_number_is_not_replaced(spark, store):
    store.publish(bundle(1))
    assert store._point(1, "other") is False and whole(store.load()) == 1


def test_damaged_published_version_is_an_error(spark, store):
    store.publish(bundle(1))
    with open(os.path.join(store.current(), "params", "part-00000-damaged.json"), "w") as f:
        f.write("not json\n")
    with pytest.raises(Exception):
        store.load()
    assert isinstance(sinks.load_models(spark, store.path + "-missing"), ModelBundle)
