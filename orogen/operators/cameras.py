"""Lens camera models over Arrow batches: linear (c, a, h, v), radial (o, r) and moving-pupil (e, type, linearity) parameters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_STEPS, _CLOSE = 100, 1e-8


@dataclass
class Camera:
    """One camera; ``o`` and ``r`` are None for a linear one, ``e`` and ``linearity`` None without a moving pupil.

    ``linearity``: 1 for perspective, 0 for fish-eye, else the general model's parameter.
    """

    c: list[float]
    a: list[float]
    h: list[float]
    v: list[float]
    o: list[float] | None = None
    r: list[float] | None = None
    e: list[float] | None = None
    linearity: float | None = None
    _k: dict = field(default_factory=dict, repr=False)

    def _p(self, name: str) -> np.ndarray:
        if name not in self._k:
            self._k[name] = np.array(getattr(self, name), float)
        return self._k[name]

    def project(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pixels (col, row), ranges) of points; range negative behind the camera, NaN where there is no image."""
        away = points - self._p("c")
        if self.e is not None:
            seen, distance = self._through_pupil(away)
        elif self.o is not None:
            seen, distance = self._bent(away), np.linalg.norm(away, axis=1)
        else:
            seen, distance = away, np.linalg.norm(away, axis=1)
        with np.errstate(invalid="ignore", divide="ignore"):
            depth = seen @ self._p("a")
            depth = np.where(np.abs(depth) <= 1e-15, np.nan, depth)
            px = np.stack([seen @ self._p("h"), seen @ self._p("v")], axis=1) / depth[:, None]
        return px, distance * np.sign(depth)

    def _bent(self, away: np.ndarray) -> np.ndarray:
        o, (r0, r1, r2) = self._p("o"), self._p("r")
        along = away @ o
        side = away - along[:, None] * o
        with np.errstate(invalid="ignore", divide="ignore"):
            tau = (side * side).sum(axis=1) / np.where(np.abs(along) <= 1e-15, np.nan, along) ** 2
        return away + (r0 + r1 * tau + r2 * tau * tau)[:, None] * side

    def _pupil(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shift of the entrance pupil at an angle from the axis, and its slope."""
        e0, e1, e2 = self._p("e")
        t2 = theta * theta
        poly, slope = e0 + t2 * (e1 + t2 * e2), theta * (2 * e1 + 4 * e2 * t2)
        sin, cos = np.sin(theta), np.cos(theta)
        safe = np.where(np.abs(sin) < 1e-12, 1.0, sin)
        factor = np.where(np.abs(sin) < 1e-12, 0.0, theta / safe - 1)
        steep = np.where(np.abs(sin) < 1e-12, 0.0, (sin - theta * cos) / (safe * safe))
        return factor * poly, steep * poly + factor * slope

    def _through_pupil(self, away: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        o, lin = self._p("o"), self.linearity if self.linearity is not None else 1.0
        zeta = away @ o
        side = away - zeta[:, None] * o
        lam = np.linalg.norm(side, axis=1)
        theta = np.arctan2(lam, zeta)
        for _ in range(_STEPS):  # the angle at which the ray through the shifted pupil reaches the point
            shift, slope = self._pupil(theta)
            sin, cos = np.sin(theta), np.cos(theta)
            miss = (zeta - shift) * sin - lam * cos
            step = miss / ((zeta - shift) * cos + lam * sin - slope * sin)
            theta = theta - step
            if np.nanmax(np.abs(step), initial=0.0) < _CLOSE:
                break
        shift, _ = self._pupil(theta)
        chi = _squeeze(theta, lin)
        r0, r1, r2 = self._p("r")
        x2 = chi * chi
        mu = 1 + r0 + x2 * (r1 + x2 * r2)
        with np.errstate(invalid="ignore", divide="ignore"):
            gain = np.where(lam > 1e-15, chi * mu / np.where(lam > 1e-15, lam, 1.0), 0.0)
        seen = o + gain[:, None] * side
        from_pupil = away - shift[:, None] * o
        return seen, np.linalg.norm(from_pupil, axis=1)

    def rays(self, pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(origins, unit directions) of the rays through pixels (col, row)."""
        a, h, v = self._p("a"), self._p("h"), self._p("v")
        d = np.cross(v - pixels[:, 1:] * a, h - pixels[:, :1] * a)
        d /= np.linalg.norm(d, axis=1, keepdims=True)
        d *= 1.0 if np.cross(v, h) @ a >= 0 else -1.0
        origin = np.broadcast_to(self._p("c"), d.shape)
        if self.e is not None:
            return self._pupil_rays(d)
        if self.o is not None:
            d = self._straight(d)
        return origin, d

    def _straight(self, d: np.ndarray) -> np.ndarray:
        """Directions without radial distortion: the share u of the sideways part that is left solves an odd quintic."""
        o, (r0, r1, r2) = self._p("o"), self._p("r")
        along = d @ o
        side = d - along[:, None] * o
        tau = (side * side).sum(axis=1) / along**2
        k1, k3, k5 = 1 + r0, r1 * tau, r2 * tau * tau
        u = 1 - (r0 + k3 + k5)
        for _ in range(_STEPS):
            u2 = u * u
            step = (((k5 * u2 + k3) * u2 + k1) * u - 1) / ((5 * k5 * u2 + 3 * k3) * u2 + k1)
            u = u - step
            if np.nanmax(np.abs(step), initial=0.0) < _CLOSE:
                break
        out = d - (1 - u)[:, None] * side
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    def _pupil_rays(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        o, (r0, r1, r2) = self._p("o"), self._p("r")
        lin = self.linearity if self.linearity is not None else 1.0
        along = d @ o
        side = d / along[:, None] - o
        size = np.linalg.norm(side, axis=1)
        chi = size.copy()
        for _ in range(_STEPS):
            x2 = chi * chi
            step = (chi * (1 + r0 + x2 * (r1 + x2 * r2)) - size) / (1 + r0 + x2 * (3 * r1 + 5 * x2 * r2))
            chi = chi - step
            if np.nanmax(np.abs(step), initial=0.0) < _CLOSE:
                break
        theta = _spread(chi, lin)
        shift, _ = self._pupil(theta)
        unit = side / np.where(size > 1e-15, size, 1.0)[:, None]
        return self._p("c") + shift[:, None] * o, np.sin(theta)[:, None] * unit + np.cos(theta)[:, None] * o


def _squeeze(theta: np.ndarray, lin: float) -> np.ndarray:
    """Image-side tangent of an angle: tan for 1, the angle for 0, sin below 0."""
    if abs(lin) < 1e-15:
        return theta
    return np.tan(lin * theta) / lin if lin > 0 else np.sin(lin * theta) / lin


def _spread(chi: np.ndarray, lin: float) -> np.ndarray:
    if abs(lin) < 1e-15:
        return chi
    return np.arctan(chi * lin) / lin if lin > 0 else np.arcsin(np.clip(chi * lin, -1, 1)) / lin


@dataclass
class Orthographic:
    """Parallel projection: pixel 0, 0 at ``origin``; a pixel is ``right`` or ``down`` wide; looks along ``forward``."""

    origin: list[float]
    right: list[float]
    down: list[float]
    forward: list[float]

    def project(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        away, r, d = points - np.array(self.origin), np.array(self.right), np.array(self.down)
        return np.stack([away @ r / (r @ r), away @ d / (d @ d)], axis=1), away @ np.array(self.forward)

    def rays(self, pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.array(self.origin) + pixels[:, :1] * np.array(self.right) + pixels[:, 1:] * np.array(self.down)
        return at, np.broadcast_to(np.array(self.forward), at.shape)


def _mapped(df: DataFrame, inputs: list[str], outputs: list[str], work) -> DataFrame:
    df = df.drop(*outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in inputs], axis=1)
            cols = [pa.array(v, pa.float64(), from_pandas=True) for v in work(x).T]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *outputs])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    return df.mapInArrow(run, ", ".join([*fields, *[f"{c} double" for c in outputs]]))


def project(points: DataFrame, camera: Camera | Orthographic) -> DataFrame:
    """Rows with x, y, z get pixel_col, pixel_row and range (null where there is no image)."""
    return _mapped(points, ["x", "y", "z"], ["pixel_col", "pixel_row", "range"], lambda x: np.column_stack(camera.project(x)))


def unproject(pixels: DataFrame, camera: Camera | Orthographic) -> DataFrame:
    """Rows with pixel_col, pixel_row get the ray's origin ox, oy, oz and unit direction dx, dy, dz."""
    return _mapped(pixels, ["pixel_col", "pixel_row"], ["ox", "oy", "oz", "dx", "dy", "dz"], lambda x: np.column_stack(camera.rays(x)))
