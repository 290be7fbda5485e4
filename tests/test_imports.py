import importlib
import pkgutil

import quarry


def test_every_module_imports():
    names = [m.name for m in pkgutil.walk_packages(quarry.__path__, "quarry.")]
    for name in names:
        importlib.import_module(name)
    assert "quarry.plans.registry" in names and "quarry.streaming.errors" in names
