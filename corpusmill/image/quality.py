"""Technical quality of images and perceptual hashes, vectorised over the pixels."""

from __future__ import annotations

import base64

import numpy as np

BLOCK, SAMPLES = 8, 64


def entropy(pixels: np.ndarray) -> float:
    """Mean over the channels of the Shannon entropy, in bits, of their 256-bin histograms."""
    total = pixels.shape[0] * pixels.shape[1]
    if not total:
        return 0.0
    bits = []
    for c in range(3):
        p = np.bincount(pixels[..., c].ravel(), minlength=256) / total
        p = p[p > 0]
        bits.append(float(-(p * np.log2(p)).sum()))
    return sum(bits) / 3


def _steps(gray: np.ndarray) -> float:
    """Mean, over up to SAMPLES lines at multiples of BLOCK, of the truncated mean difference to the next line."""
    size = gray.shape[0]
    at = np.arange(min((size - 1) // BLOCK, SAMPLES)) * BLOCK
    if not len(at):
        return 0.0
    sums = np.abs(gray[at] - gray[at + 1]).sum(axis=1) // gray.shape[1]
    return float(sums.sum()) / len(at) / 255


def artifacts(pixels: np.ndarray, size: int) -> float:
    """0.6 of the blockiness at 8-pixel borders and 0.4 of how far the file is below half its raw size, in [0, 1]."""
    height, width = pixels.shape[:2]
    if not height or not width:
        return 0.0
    gray = pixels.astype(np.int64).sum(axis=2) // 3
    blockiness = (_steps(gray) + _steps(gray.T)) / 2
    dense = min(1.0, 2 * size / (width * height * 3))
    return min(1.0, max(0.0, 0.6 * blockiness + 0.4 * (1 - dense)))


def luma(pixels: np.ndarray) -> np.ndarray:
    """ITU-R 601 luma, rounded as 16-bit fixed point."""
    r, g, b = (pixels[..., c].astype(np.int64) for c in range(3))
    return (r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16


def resize(gray: np.ndarray, width: int, height: int) -> np.ndarray:
    """Lanczos resampling with support 3, widened for shrinking."""
    return _lanczos(_lanczos(gray.astype(np.float64), width).T, height).T


def _lanczos(lines: np.ndarray, size: int) -> np.ndarray:
    old = lines.shape[1]
    scale = old / size
    wide = max(scale, 1.0)
    centre = (np.arange(size) + 0.5) * scale
    x = (np.arange(old)[None, :] + 0.5 - centre[:, None]) / wide
    weight = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return np.clip(np.round(lines @ (weight / weight.sum(axis=1, keepdims=True)).T), 0, 255)


def phash(pixels: np.ndarray, hash_size: int = 16) -> str:
    """Hex of which low frequencies of a DCT exceed their median."""
    n = 4 * hash_size
    small = resize(luma(pixels), n, n)
    k = np.arange(n)
    dct = 2 * np.cos(np.pi * k[:hash_size, None] * (2 * k[None, :] + 1) / (2 * n))
    low = dct @ small @ dct.T
    bits = (low > np.median(low)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):0{-(-len(bits) // 4)}x}"


def gradient_hash(pixels: np.ndarray, hash_size: int = 16) -> str:
    """Base64 of horizontal and vertical gradient signs."""
    half = hash_size // 2
    small = resize(luma(pixels), half + 1, half + 1)
    bits = np.concatenate(((small[:-1, :-1] < small[:-1, 1:]).ravel(), (small[:-1, :-1] < small[1:, :-1]).ravel()))
    return base64.b64encode(np.packbits(bits, bitorder="little").tobytes()).decode()
