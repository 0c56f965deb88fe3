"""Image kernels over decoded arrays: uint8, height x width or height x width x channels.

They are numpy functions; ``measure`` runs them over a column of raw pixels in Arrow batches. Codecs are
injected, as no image library is at hand; a raw image is its bytes with width, height and channels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from sheafline.plans import schema as S

#: Fixed value: weights of blue, green and red in grey.
_GREY = np.array([0.114, 0.587, 0.299])
#: Exchanges of the smaller and the larger that leave the median of nine in the middle.
_MEDIAN_OF_NINE = (
    (1, 2), (4, 5), (7, 8), (0, 1), (3, 4), (6, 7), (1, 2), (4, 5), (7, 8), (0, 3),
    (5, 8), (4, 7), (3, 6), (1, 4), (2, 5), (4, 7), (4, 2), (6, 4), (4, 2),
)


def pixels(content: bytes, width: int, height: int, channels: int) -> np.ndarray:
    shape = (height, width) if channels == 1 else (height, width, channels)
    return np.frombuffer(content, np.uint8).reshape(shape)


def stacked(contents: Sequence[bytes], width: int, height: int, channels: int) -> np.ndarray:
    """Images of one shape as one array, height x width x images x channels: the kernels that work on each pixel,
    row or column alike (grey, layouts, brightness, sizes, turns) take all of them at once."""
    shape = (len(contents), height, width, channels)
    return np.moveaxis(np.frombuffer(b"".join(contents), np.uint8).reshape(shape), 0, 2)


def dimensions(image: np.ndarray) -> tuple[int, int]:
    return image.shape[1], image.shape[0]


def channels(image: np.ndarray) -> int:
    return 1 if image.ndim == 2 else image.shape[-1]


def _saturated(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


def grayscale(image: np.ndarray) -> np.ndarray:
    if image.ndim == 2:
        return image
    # Sums of planes, as a product of matrices may round by the number of its rows.
    return _saturated(sum(image[..., c] * weight for c, weight in enumerate(_GREY)))


def convert(image: np.ndarray, layout: str) -> np.ndarray:
    """To GRAY, BGR or BGRA; a new alpha is opaque."""
    if layout == "GRAY":
        return grayscale(image)
    colour = np.repeat(image[..., None], 3, 2) if image.ndim == 2 else image[..., :3]
    if layout == "BGR":
        return colour
    if layout == "BGRA":
        alpha = image[..., 3:] if image.ndim > 2 and image.shape[-1] == 4 else np.full((*colour.shape[:-1], 1), 255, np.uint8)
        return np.concatenate([colour, alpha], -1)
    raise ValueError(f"unknown layout {layout!r}")


def _area_weights(size: int, target: int) -> np.ndarray:
    """How much each source pixel gives to each target pixel when areas are averaged."""
    edges = np.linspace(0, size, target + 1)
    lo, hi = edges[:-1, None], edges[1:, None]
    cells = np.arange(size)
    return np.clip(np.minimum(hi, cells + 1) - np.maximum(lo, cells), 0, 1) / (hi - lo)


def resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Averaged areas; sizes must be positive."""
    if width <= 0 or height <= 0:
        raise ValueError("a size must be positive")
    rows, columns = _area_weights(image.shape[0], height), _area_weights(image.shape[1], width)
    return _saturated(np.einsum("ij,jk...,lk->il...", rows, image.astype(float), columns, optimize=True))


def _cubic(size: int, factor: float) -> np.ndarray:
    target = int(round(size * factor))
    at = (np.arange(target) + 0.5) / factor - 0.5
    base, found = np.floor(at).astype(int), np.zeros((target, size))
    for k in range(-1, 3):
        x, a = np.abs(at - (base + k)), -0.75
        weight = np.where(x <= 1, ((a + 2) * x - (a + 3)) * x * x + 1, ((a * x - 5 * a) * x + 8 * a) * x - 4 * a)
        np.add.at(found, (np.arange(target), np.clip(base + k, 0, size - 1)), weight)
    return found


def upscale(image: np.ndarray, factor: float) -> np.ndarray:
    """Bicubic, by more than 1."""
    if factor <= 1:
        raise ValueError("a factor must be over 1")
    rows, columns = _cubic(image.shape[0], factor), _cubic(image.shape[1], factor)
    return _saturated(np.einsum("ij,jk...,lk->il...", rows, image.astype(float), columns, optimize=True))


def _windows(image: np.ndarray, size: int, mode: str = "reflect") -> np.ndarray:
    half = size // 2
    padded = np.pad(image, half, mode=mode if min(image.shape) > half else "edge")
    return np.lib.stride_tricks.sliding_window_view(padded, (size, size))


def _around(image: np.ndarray, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of 3 x 3, edges repeated: down the columns, then along the rows."""
    padded = np.pad(image, 1, mode="edge")
    tall = pick(pick(padded[:-2], padded[1:-1]), padded[2:])
    return pick(pick(tall[:, :-2], tall[:, 1:-1]), tall[:, 2:])


def median_filter(gray: np.ndarray, size: int) -> np.ndarray:
    if size != 3:
        return np.median(_windows(gray, size, "edge"), axis=(2, 3))
    padded = np.pad(gray, 1, mode="edge")
    nine = [padded[y : y + gray.shape[0], x : x + gray.shape[1]] for y in range(3) for x in range(3)]
    for low, high in _MEDIAN_OF_NINE:
        nine[low], nine[high] = np.minimum(nine[low], nine[high]), np.maximum(nine[low], nine[high])
    return nine[4].astype(float)


def _gauss(size: int, sigma: float) -> np.ndarray:
    x = np.arange(size) - (size - 1) / 2
    kernel = np.exp(-x * x / (2 * sigma * sigma))
    return kernel / kernel.sum()


def _blurred(plane: np.ndarray, kernel: np.ndarray, mode: str = "reflect") -> np.ndarray:
    half = len(kernel) // 2
    padded = np.pad(plane.astype(float), half, mode=mode if min(plane.shape) > half else "edge")
    across = np.lib.stride_tricks.sliding_window_view(padded, len(kernel), 1) @ kernel
    return np.lib.stride_tricks.sliding_window_view(across, len(kernel), 0) @ kernel


def _by_channel(image: np.ndarray, f) -> np.ndarray:
    return f(image) if image.ndim == 2 else np.stack([f(image[..., c]) for c in range(image.shape[2])], -1)


def equalize(gray: np.ndarray, clip_limit: float = 2.0, tiles: int = 8) -> np.ndarray:
    """Contrast-limited adaptive equalisation: clipped histograms of tiles, blended between centres."""
    height, width = gray.shape
    th, tw = -(-height // tiles), -(-width // tiles)
    padded = np.pad(gray, ((0, th * tiles - height), (0, tw * tiles - width)), mode="reflect" if min(height, width) > max(th, tw) else "edge")
    maps = np.empty((tiles, tiles, 256))
    limit = max(1, int(clip_limit * th * tw / 256))
    for i in range(tiles):
        for j in range(tiles):
            counts = np.bincount(padded[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel(), minlength=256)
            over = int(np.maximum(counts - limit, 0).sum())
            counts = np.minimum(counts, limit) + over // 256
            counts[:: max(1, 256 // max(1, over % 256))][: over % 256] += 1
            maps[i, j] = np.clip(np.rint(np.cumsum(counts) * 255.0 / (th * tw)), 0, 255)
    y, x = np.arange(height) / th - 0.5, np.arange(width) / tw - 0.5
    i0, j0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - i0)[:, None], (x - j0)[None, :]
    at = lambda i, j: maps[np.clip(i, 0, tiles - 1)[:, None], np.clip(j, 0, tiles - 1)[None, :], gray]
    return _saturated((at(i0, j0) * (1 - fx) + at(i0, j0 + 1) * fx) * (1 - fy) + (at(i0 + 1, j0) * (1 - fx) + at(i0 + 1, j0 + 1) * fx) * fy)


def brighten(image: np.ndarray, delta: float) -> np.ndarray:
    return _saturated(image.astype(float) + delta)


def denoise(gray: np.ndarray, strength: float = 8.0, template: int = 7, search: int = 21) -> np.ndarray:
    """Non-local means: each pixel the mean of those around it, weighted by how alike their patches are."""
    half, reach = template // 2, search // 2
    wide = np.pad(gray.astype(float), half + reach, mode="reflect" if min(gray.shape) > half + reach else "edge")
    height, width = gray.shape
    box = np.ones(template) / template
    total, weight = np.zeros(gray.shape), np.zeros(gray.shape)
    own = wide[reach : reach + height + 2 * half, reach : reach + width + 2 * half]
    for dy in range(-reach, reach + 1):
        for dx in range(-reach, reach + 1):
            moved = wide[reach + dy : reach + dy + height + 2 * half, reach + dx : reach + dx + width + 2 * half]
            gap = (own - moved) ** 2
            across = np.lib.stride_tricks.sliding_window_view(gap, template, 1) @ box
            alike = np.exp(-(np.lib.stride_tricks.sliding_window_view(across, template, 0) @ box) / (strength * strength))
            total += alike * moved[half : half + height, half : half + width]
            weight += alike
    return _saturated(total / weight)


def sharpen(image: np.ndarray, sigma: float = 1.5, amount: float = 0.6, size: int = 3) -> np.ndarray:
    """Unsharp mask."""
    return _saturated(_by_channel(image, lambda p: p * (1 + amount) - amount * _blurred(p, _gauss(size, sigma))))


def flatten(gray: np.ndarray, kernel: int = 7, median: int = 21) -> np.ndarray:
    """The page divided by its own background: dilated, then median-filtered."""
    ground = median_filter(_windows(gray, kernel, "edge").max(axis=(2, 3)), median)
    return _saturated(gray.astype(float) * 255.0 / np.maximum(ground, 1.0))


def binarize(gray: np.ndarray, block_size: int, constant: float) -> np.ndarray:
    """White where a pixel is over its weighted surroundings less a constant; the block is odd, over 1."""
    if block_size < 3 or block_size % 2 == 0:
        raise ValueError("a block is odd and at least 3")
    sigma = 0.3 * ((block_size - 1) * 0.5 - 1) + 0.8
    mean = np.rint(_blurred(gray, _gauss(block_size, sigma), "edge"))
    return np.where(gray > mean - constant, 255, 0).astype(np.uint8)


def _filtered(gray: np.ndarray, kernel: list[list[int]]) -> np.ndarray:
    return np.einsum("ijkl,kl->ij", _windows(gray.astype(float), 3), np.array(kernel, float))


def blur_score(gray: np.ndarray) -> float:
    """Variance of the Laplacian."""
    return float(_filtered(gray, [[0, 1, 0], [1, -4, 1], [0, 1, 0]]).var())


def sharpness_score(gray: np.ndarray) -> float:
    """Mean of both Sobel gradients' magnitudes."""
    x = [[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]]
    return float((np.abs(_filtered(gray, x)) + np.abs(_filtered(gray, np.transpose(x).tolist()))).mean())


def contrast_score(gray: np.ndarray) -> float:
    return float(gray.std())


def brightness_score(gray: np.ndarray) -> float:
    return float(gray.mean())


def noise_score(gray: np.ndarray) -> float:
    """Mean distance from the median of 3 x 3."""
    return float(np.abs(gray.astype(float) - median_filter(gray, 3)).mean())


def ink(gray: np.ndarray) -> np.ndarray:
    return gray <= S.INK_LEVEL


def orientation(gray: np.ndarray) -> int | None:
    """0 if the ink's box and the page are both wide or both tall, else 90; None without ink."""
    rows, columns = np.nonzero(ink(gray))
    if not len(rows):
        return None
    width, height = np.ptp(columns) + 1, np.ptp(rows) + 1
    return 0 if (width >= height) == (gray.shape[1] >= gray.shape[0]) else 90


def _hull(points: np.ndarray) -> np.ndarray:
    """The corners around points, in order."""
    points = points[np.lexsort((points[:, 1], points[:, 0]))]
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    sides = []
    for run in (points.tolist(), points[::-1].tolist()):
        side: list = []
        for p in run:
            while len(side) > 1 and cross(side[-2], side[-1], p) <= 0:
                side.pop()
            side.append(p)
        sides += side[:-1]
    return np.array(sides)


def skew_angle(gray: np.ndarray) -> float | None:
    """The angle of the smallest rectangle around the ink, within 45 degrees; None without ink."""
    rows, columns = np.nonzero(ink(gray))
    if not len(rows):
        return None
    # Only the ends of each row can be corners.
    at = np.unique(rows, return_index=True)
    ends = np.concatenate([columns[at[1]], columns[np.r_[at[1][1:], len(rows)] - 1]])
    hull = _hull(np.unique(np.stack([ends, np.tile(at[0], 2)], 1).astype(float), axis=0))
    if len(hull) < 3:
        return 0.0
    edges = np.diff(np.vstack([hull, hull[:1]]), axis=0)
    best = None
    for angle in np.unique(np.arctan2(edges[:, 1], edges[:, 0]) % (np.pi / 2)):
        turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
        size = np.prod(np.ptp(hull @ turn, axis=0))
        if best is None or size < best[0] - 1e-9:
            best = (size, angle)
    degrees = float(np.degrees(best[1]))
    return degrees - 90 if degrees > 45 else degrees


def rotate(image: np.ndarray, angle: float, border: int = 255) -> np.ndarray:
    """About the centre, counter-clockwise, in the same frame, bilinear; a white border."""
    height, width = image.shape[:2]
    t, cy, cx = np.radians(angle), (height - 1) / 2, (width - 1) / 2
    y, x = np.mgrid[:height, :width].astype(float)
    sx = np.cos(t) * (x - cx) - np.sin(t) * (y - cy) + cx
    sy = np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy

    def plane(p: np.ndarray) -> np.ndarray:
        wide = np.pad(p.astype(float), 1, constant_values=border)
        px, py = np.clip(sx + 1, 0, width + 0.999), np.clip(sy + 1, 0, height + 0.999)
        i, j = py.astype(int), px.astype(int)
        fy, fx = py - i, px - j
        i1, j1 = np.minimum(i + 1, height + 1), np.minimum(j + 1, width + 1)
        return (wide[i, j] * (1 - fx) + wide[i, j1] * fx) * (1 - fy) + (wide[i1, j] * (1 - fx) + wide[i1, j1] * fx) * fy

    return _saturated(_by_channel(image, plane))


def deskew(image: np.ndarray, skew: float) -> np.ndarray:
    return rotate(image, skew)


def _labels(mask: np.ndarray) -> np.ndarray:
    """Numbers of 8-connected regions, by passing the smallest number on until none changes."""
    found = np.where(mask, np.arange(1, mask.size + 1).reshape(mask.shape), 0)
    big = mask.size + 1
    while True:
        around = _around(np.where(mask, found, big), np.minimum)
        least = np.where(mask, np.minimum(found, around), 0)
        # Follow each number to the one that its own first pixel has now.
        flat = least.ravel()
        jump = np.where(flat > 0, np.minimum(flat, flat[np.maximum(flat - 1, 0)]), 0).reshape(mask.shape)
        if np.array_equal(jump, found):
            return found
        found = jump


def text_regions(image: np.ndarray) -> list[tuple[float, float, float, float, float]]:
    """(l, t, r, b, share of ink) of the closed ink's regions of REGION_AREA_MIN or more, by top and left."""
    marks = ink(grayscale(image))
    wide = _around(np.pad(marks, 1), np.maximum)
    closed = _around(wide, np.minimum)[1:-1, 1:-1]
    labels = _labels(closed)
    rows, columns = np.nonzero(labels)
    if not len(rows):
        return []
    kinds, back = np.unique(labels[rows, columns], return_inverse=True)
    found = []
    lo_r, hi_r = np.full(len(kinds), 1 << 30), np.zeros(len(kinds), int)
    lo_c, hi_c = lo_r.copy(), hi_r.copy()
    np.minimum.at(lo_r, back, rows), np.maximum.at(hi_r, back, rows)
    np.minimum.at(lo_c, back, columns), np.maximum.at(hi_c, back, columns)
    for t, b, l, r in zip(lo_r, hi_r + 1, lo_c, hi_c + 1):
        if (r - l) * (b - t) >= S.REGION_AREA_MIN:
            found.append((float(l), float(t), float(r), float(b), float(marks[t:b, l:r].mean())))
    return sorted(found, key=lambda f: (f[1], f[0]))


def text_coverage(regions: list[tuple], width: int, height: int) -> float:
    if width <= 0 or height <= 0:
        return 0.0
    return min(1.0, sum(max(0.0, r - l) * max(0.0, b - t) for l, t, r, b, _ in regions) / (width * height))


def fit_for_vision(image: np.ndarray, longest: int = S.VLM_SIDE_MAX) -> np.ndarray:
    """Scaled down so that the longest side fits; smaller images stay."""
    height, width = image.shape[:2]
    factor = longest / max(height, width)
    return image if factor >= 1 else resize(image, max(1, round(width * factor)), max(1, round(height * factor)))


KERNELS = {
    "grayscale": lambda i, p: grayscale(i),
    "upscale": lambda i, p: upscale(i, p["scale"]),
    "denoise": lambda i, p: denoise(i),
    "equalize": lambda i, p: equalize(i, p["clip_limit"]),
    "flatten": lambda i, p: flatten(i),
    "orientation": lambda i, p: np.rot90(i, -1),
    "deskew": lambda i, p: deskew(i, p["skew"]),
    "sharpen": lambda i, p: sharpen(i),
    "correct_orientation": lambda i, p: rotate(i, float(p["orientation"])),
    "normalize_brightness": lambda i, p: brighten(i, p["shift"]),
    "resize": lambda i, p: fit_for_vision(i),
    "binarize": lambda i, p: binarize(i, p["block_size"], p["constant"]),
}


def apply_steps(image: np.ndarray, steps: list[str], values: dict) -> np.ndarray:
    """The kernels that a plan names, in its order."""
    for step in steps:
        image = KERNELS[step](image, values)
    return image


MEASURED = (
    "blur double, sharpness double, contrast double, brightness double, noise double, orientation int, skew double, "
    "text_coverage double, regions array<struct<l:double,t:double,r:double,b:double,coverage:double>>"
)


def measured(image: np.ndarray) -> tuple:
    gray, regions = grayscale(image), text_regions(image)
    return (
        blur_score(gray), sharpness_score(gray), contrast_score(gray), brightness_score(gray), noise_score(gray), orientation(gray),
        skew_angle(gray), text_coverage(regions, image.shape[1], image.shape[0]), regions,
    )


def measure(images: DataFrame, key: str) -> DataFrame:
    """(key, measurements) of raw images (key, content, width, height, channels), batch by batch."""
    names = [c.split()[0] for c in MEASURED.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [measured(pixels(*r)) for r in zip(frame["content"], frame["width"], frame["height"], frame["channels"])]
            found = pd.DataFrame(rows, columns=names)
            found["regions"] = [[dict(zip(("l", "t", "r", "b", "coverage"), r)) for r in x] for x in found["regions"]]
            found["orientation"] = found["orientation"].astype("Int32")
            found.insert(0, key, frame[key].to_numpy())
            yield found

    kind = images.schema[key].dataType.simpleString()
    return images.select(key, "content", "width", "height", "channels").mapInPandas(run, f"{key} {kind}, {MEASURED}")
