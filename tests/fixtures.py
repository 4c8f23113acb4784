"""Seeded telemetry from a table of phases; one row an hour, device after device."""

from datetime import datetime, timedelta

import numpy as np

from voltarc.config import ocv_curve

COLUMNS = "source_table string, device_id bigint, channel string, loop_count double, remaining_ah double, soc double, voltage double, current double, temperature double, ts timestamp_ntz"

#: A cycle: hours, state of charge at the end, amperes, volts over the open-circuit voltage.
PHASES = ((50, 1.00, 20.0, 3.0), (20, 1.00, 0.0, 0.0), (50, 0.02, -15.0, -1.0), (40, 0.02, 0.0, 0.0))
STEP, EMPTY, TRICKLE, CELLS = 0.02, 0.02, 2.0, 21
BEGIN = datetime(2024, 3, 1)


def cycle():
    """(charge, amperes, volts over rest) of each hour of PHASES; near full, charging trickles."""
    charge, amperes, volts, last = [], [], [], EMPTY
    for hours, until, current, shift in PHASES:
        way = np.arange(1, hours + 1) * STEP
        own = np.minimum(until, last + way) if until >= last else np.maximum(until, last - way)
        charge.append(own)
        amperes.append(np.where((current > 0) & (own > 0.95) & (own < 1.0), TRICKLE, current))
        volts.append(np.full(hours, shift))
        last = own[-1]
    return tuple(map(np.concatenate, (charge, amperes, volts)))


def raw_rows(devices=3, cycles=12, seed=0):
    """Capacity 40 - 0.5 d, fading by 0.05 a cycle; noise of 0.02 V."""
    charge, amperes, shift = cycle()
    hours = charge.size
    rested = np.interp(charge, *ocv_curve("NMC")) * CELLS + shift
    which, turn, hour = (x.ravel() for x in np.meshgrid(range(devices), range(cycles), range(hours), indexing="ij"))
    full = 40.0 - 0.5 * which - 0.05 * turn
    volts = rested[hour] + np.random.default_rng(seed).normal(0, 0.02, which.size)
    table = zip((11000001 + which).tolist(), turn.tolist(), np.round(full * charge[hour], 3).tolist(), np.round(charge[hour], 2).tolist(), np.round(volts, 2).tolist(), amperes[hour].tolist(), strict=True)
    return [("bms_test", d, "TEST", float(n), ah, soc, v, i, 25.0, BEGIN + timedelta(hours=k)) for k, (d, n, ah, soc, v, i) in enumerate(table)]


def c_nom_rows(devices=3):
    return [("TEST", 11000001 + d, 40.0 - 0.5 * d) for d in range(devices)]
