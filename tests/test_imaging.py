"""Image kernels against plain loops and simple facts."""

import numpy as np
import pytest

from sheafline.functions import imaging as I

RNG = np.random.default_rng(3)


def test_layouts():
    colour = RNG.integers(0, 256, (5, 7, 3), np.uint8)
    assert I.dimensions(colour) == (7, 5) and I.channels(colour) == 3 and I.channels(I.grayscale(colour)) == 1
    assert I.convert(colour, "BGRA").shape == (5, 7, 4) and I.convert(I.grayscale(colour), "BGR").shape == (5, 7, 3)
    assert (I.convert(I.convert(colour, "BGRA"), "BGR") == colour).all()
    with pytest.raises(ValueError):
        I.convert(colour, "CMYK")


def test_sizes():
    gray = RNG.integers(0, 256, (12, 8), np.uint8)
    assert (I.resize(gray, 8, 12) == gray).all()
    assert I.resize(gray, 4, 6)[0, 0] == round(float(gray[:2, :2].mean()))
    assert I.upscale(gray, 2.0).shape == (24, 16) and (I.upscale(np.full((5, 5), 9, np.uint8), 3.0) == 9).all()
    assert max(I.fit_for_vision(np.zeros((10, 3000), np.uint8)).shape) == 2000
    for bad in (lambda: I.resize(gray, 0, 5), lambda: I.upscale(gray, 1.0)):
        with pytest.raises(ValueError):
            bad()


def test_scores():
    flat = np.full((10, 10), 100, np.uint8)
    assert I.blur_score(flat) == I.sharpness_score(flat) == I.contrast_score(flat) == I.noise_score(flat) == 0
    assert I.brightness_score(flat) == 100
    gray = RNG.integers(0, 256, (9, 11), np.uint8)
    wide = np.pad(gray.astype(float), 1, mode="reflect")
    laplace = [[wide[i, j + 1] + wide[i + 2, j + 1] + wide[i + 1, j] + wide[i + 1, j + 2] - 4 * wide[i + 1, j + 1] for j in range(11)] for i in range(9)]
    assert I.blur_score(gray) == pytest.approx(np.var(laplace))
    edge = np.pad(gray, 1, mode="edge")
    medians = np.array([[np.median(edge[i : i + 3, j : j + 3]) for j in range(11)] for i in range(9)])
    assert I.noise_score(gray) == pytest.approx(np.abs(gray - medians).mean())


def test_ink():
    page = np.full((40, 60), 255, np.uint8)
    assert I.orientation(page) is None and I.skew_angle(page) is None and I.text_regions(page) == []
    page[10:14, 5:55] = 0
    assert I.orientation(page) == 0 and I.orientation(page.T.copy()) == 0
    page[:, :] = 255
    page[2:38, 30:34] = 0
    assert I.orientation(page) == 90
    assert abs(I.skew_angle(page)) < 1e-6


def test_skew_is_found_and_undone():
    page = np.full((200, 200), 255, np.uint8)
    page[80:120, 40:160] = 0
    turned = I.rotate(page, 5.0)
    skew = I.skew_angle(turned)
    assert abs(abs(skew) - 5.0) < 1.0
    assert abs(I.skew_angle(I.deskew(turned, skew))) < abs(skew)


def test_regions():
    page = np.full((50, 50), 255, np.uint8)
    page[30:40, 5:20] = 0
    page[5:15, 25:45] = 0
    page[45:47, 45:47] = 0  # speckle
    found = I.text_regions(page)
    assert [(r[0], r[1], r[2], r[3]) for r in found] == [(25, 5, 45, 15), (5, 30, 20, 40)] and found[0][4] == 1.0
    assert I.text_coverage(found, 50, 50) == pytest.approx((200 + 150) / 2500) and I.text_coverage(found, 0, 5) == 0


def test_corrections():
    gray = RNG.integers(60, 200, (40, 40), np.uint8)
    assert I.brighten(gray, 300).min() == 255 and I.brighten(gray, -300).max() == 0
    assert I.denoise(gray).std() <= gray.std() and I.sharpen(gray).std() >= gray.std() * 0.99
    assert set(np.unique(I.binarize(gray, 15, 2.0))) <= {0, 255} and I.flatten(np.full((30, 30), 90, np.uint8)).min() == 255
    assert I.equalize(gray).shape == gray.shape and (I.denoise(np.full((20, 20), 7, np.uint8)) == 7).all()
    with pytest.raises(ValueError):
        I.binarize(gray, 4, 1.0)


def test_a_stack_is_its_images():
    images = RNG.integers(0, 256, (300, 4, 6, 3), np.uint8)
    images[::2] -= images[::2] % 5  # ties of a half among them
    stack = I.stacked([i.tobytes() for i in images], 6, 4, 3)
    for whole, one in (
        (I.grayscale(stack), I.grayscale), (I.brighten(stack, 60), lambda i: I.brighten(i, 60)), (I.resize(I.grayscale(stack), 3, 2), lambda i: I.resize(I.grayscale(i), 3, 2)),
        (I.upscale(I.grayscale(stack), 2), lambda i: I.upscale(I.grayscale(i), 2)), (I.apply_steps(stack, ["orientation"], {}), lambda i: I.apply_steps(i, ["orientation"], {})),
        (I.convert(stack, "BGRA"), lambda i: I.convert(i, "BGRA")),
    ):
        assert all((whole[:, :, n] == one(image)).all() for n, image in enumerate(images))
    assert I.dimensions(stack) == (6, 4) and I.channels(I.convert(stack, "BGRA")) == 4
    assert I.stacked([], 6, 4, 3).shape == (4, 6, 0, 3)


def test_kernels_run_once_a_batch(monkeypatch):
    import pandas as pd

    from sheafline.catalog import workflow

    calls, resize = [], I.resize
    monkeypatch.setattr(I, "resize", lambda *a: calls.append(1) or resize(*a))
    frame = pd.DataFrame({"p_partkey": range(1000), "content": [bytes((n + i) % 256 for i in range(12)) for n in range(1000)]})
    told = pd.concat(workflow._kernels(iter([frame, frame[:7]])))
    assert len(told) == 1007 and len(calls) == 2
