"""Proof queries on the driver's test tables; importing this package fills the registry."""

import importlib
import pkgutil

from tallyloom.proofs.registry import ORACLES, PLANS, Tables, proof

for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["ORACLES", "PLANS", "Tables", "proof"]
