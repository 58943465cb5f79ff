"""An independent, sequential model of decode and rasterization, for comparison on small volumes."""

from __future__ import annotations

import math
import struct

import numpy as np

PREFIX = {"reflectivity": b"REF", "velocity": b"VEL", "spectrum_width": b"SW", "differential_reflectivity": b"ZDR"}
PREFIX |= {"differential_phase": b"PHI", "correlation_coefficient": b"RHO"}
LIMITS = {"reflectivity": (-32, 94.5), "velocity": (-100, 100), "spectrum_width": (0, 64)}
LIMITS |= {"differential_reflectivity": (-8, 8), "differential_phase": (0, 360), "correlation_coefficient": (0, 1.1)}
F4 = np.float32


def tenth(v):
    x = float(F4(v) * F4(10))
    return F4(math.copysign(math.floor(abs(x) + 0.5), x)) * F4(0.1)


class Model:
    """Feeds complete radial payloads, in order, to per-product state."""

    def __init__(self, products):
        self.products, self.sweeps, self.geometry, self.bins = products, [], {}, []
        self.rays, self.elev, self.span = {}, 0xFF, {p: (0.0, 0.0) for p in products}
        self.site, self.count = None, 0

    def start(self, elevation, elev_num):
        self.sweeps.append({"elevation": F4(elevation), "elev_num": elev_num, "rays": 0})
        self.elev = elev_num

    def ray(self):
        sweep = self.sweeps[-1]
        sweep["rays"] += 1
        key = int(math.floor(float(sweep["elevation"] * F4(100)) + 0.5))
        self.rays[key] = self.rays.get(key, 0) + 1
        self.count += 1

    def range(self, product, metres):
        last, best = self.span[product]
        self.span[product] = (metres, max(best, metres))

    def moment(self, product, seq, azimuth, raw, first, spacing, offset, scale):
        if len(raw) > 10:
            self.geometry.setdefault(product, (len(raw), F4(first), F4(spacing)))
        for g, r in enumerate(raw):
            if r <= 1:
                continue
            v = (F4(r) - F4(offset)) / F4(scale)
            if product == "reflectivity" and v < -32:
                continue
            self.bins.append((product, len(self.sweeps) - 1, seq, g, F4(azimuth), F4(first) + F4(g) * F4(spacing), tenth(v)))

    def add(self, seq, kind, p):
        if kind == 1:
            self.add_legacy(seq, p)
        elif kind == 31:
            self.add_generic(seq, p)

    def add_legacy(self, seq, p):
        if len(p) < 32:
            return
        az, el = (F4(struct.unpack_from(">H", p, at)[0]) * F4(360 / 65536) for at in (8, 16))
        if el > 90:
            return
        if p[1] in (0, 3, 5) or not self.sweeps:
            self.start(el, 0xFF)
        self.ray()
        if "reflectivity" not in self.products or len(p) < 46:
            return
        first, spacing, n, span = (struct.unpack_from(">H", p, at)[0] for at in (20, 22, 24, 26))
        if span:
            self.range("reflectivity", span * 100.0)
        if n and len(p) >= 46 + n:
            self.moment("reflectivity", seq, az, list(p[46 : 46 + n]), first, spacing, 66, 2)

    def add_generic(self, seq, p):
        if len(p) < 72:
            return
        (az,), (el,), (count,) = struct.unpack_from(">f", p, 12), struct.unpack_from(">f", p, 24), struct.unpack_from(">H", p, 30)
        if not 1 <= count <= 10 or not (-0.1 <= az <= 360.1 and -5 <= el <= 90):
            return
        if p[21] in (0, 3, 5) or not self.sweeps or p[22] != self.elev:
            self.start(el, p[22])
        self.ray()
        for at in struct.unpack_from(f">{count}I", p, 32):
            if at == 0 or at + 4 > len(p):
                continue
            name = p[at + 1 : at + 4]
            if name == b"VOL":
                if at + 44 <= len(p):
                    f = struct.unpack_from(">c3sHBBffhHfffffHH", p, at)
                    self.site = (f[5], f[6], f[7] + f[8], f[12], f[13], f[14])
            elif name == b"RAD":
                if at + 20 <= len(p):
                    span = struct.unpack_from(">H", p, at + 6)[0]
                    for product in self.products if span else ():
                        self.range(product, span * 100.0)
            elif p[at : at + 1] == b"D" and at + 28 <= len(p):
                n, first, spacing, _, _, word, scale, offset = struct.unpack_from(">HHHHHHff", p, at + 8)
                word = word or 8
                if n == 0 or n > 8000 or spacing == 0 or word not in (8, 16) or scale == 0 or at + 28 + n * word // 8 > len(p):
                    continue
                raw = struct.unpack_from(f">{n}{'H' if word == 16 else 'B'}", p, at + 28)
                for product in self.products:
                    if name.startswith(PREFIX[product]):
                        self.moment(product, seq, az, raw, first, spacing, offset, scale)

    def tilts(self):
        return sorted({s["elevation"] for s in self.sweeps})

    def grids(self, product):
        """(2-D grid per tilt, 3-D grid), or None without geometry."""
        if product not in self.geometry:
            return None
        n, first, spacing = self.geometry[product]
        low, high = LIMITS[product]
        tilts = self.tilts()
        volume = np.zeros((len(tilts), 720, n), "u1")
        flat = []
        for t, tilt in enumerate(tilts):
            key = int(math.floor(float(tilt * F4(100)) + 0.5))
            rays = 720 if self.rays.get(key, 0) > 400 else 360
            grid = np.zeros((rays, n), "u1")
            for prod, sweep, _, _, az, rng, v in self.bins:
                if prod != product or not abs(self.sweeps[sweep]["elevation"] - tilt) < F4(0.01):
                    continue
                unit = min(max((v - F4(low)) / (F4(high) - F4(low)), F4(0)), F4(1))
                code = int(math.floor(float(F4(unit) * F4(255)) + 0.5))
                gate = int(math.floor((rng - first) / spacing))
                if code == 0 or not 0 <= gate < n:
                    continue
                ray = int(math.floor(az * F4(rays / 360) + F4(0.01))) % rays
                full = int(math.floor(az * F4(2) + F4(0.01))) % 720
                grid[ray, gate] = max(grid[ray, gate], code)
                for r in [full] if rays == 720 else [full, (full + 1) % 720]:
                    volume[t, r, gate] = max(volume[t, r, gate], code)
            flat.append(grid)
        return flat, volume
