"""Pixel kernels: separable Lanczos resize and the DCT perceptual hash."""

from __future__ import annotations

import numpy as np

LANCZOS_LOBES = 3

# Side of the grey image and of the kept low-frequency block.
HASH_SIDE, HASH_BLOCK = 32, 8

# Weights of blue, green and red in the grey value.
GREY_BGR = (0.114, 0.587, 0.299)


def lanczos_weights(source: int, target: int) -> np.ndarray:
    """(target, source) matrix of resampling weights, rows summing to 1."""
    scale = max(source / target, 1.0)
    centres = (np.arange(target) + 0.5) * source / target
    x = (np.arange(source)[None, :] + 0.5 - centres[:, None]) / scale
    weights = np.where(np.abs(x) < LANCZOS_LOBES, np.sinc(x) * np.sinc(x / LANCZOS_LOBES), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def resize(pixels: np.ndarray, width: int, height: int) -> np.ndarray:
    """Resize (rows, columns, channels) bytes with a Lanczos kernel."""
    down = np.einsum("ij,jkc->ikc", lanczos_weights(pixels.shape[0], height), pixels.astype(np.float64))
    across = np.einsum("kl,ilc->ikc", lanczos_weights(pixels.shape[1], width), down)
    return np.clip(np.rint(across), 0, 255).astype(np.uint8)


def three_channels(pixels: np.ndarray) -> np.ndarray:
    """Blue, green and red of any decoded image: grey is repeated, alpha is dropped."""
    if pixels.shape[2] == 1:
        return np.repeat(pixels, 3, axis=2)
    if pixels.shape[2] == 2:  # grey with alpha
        return np.repeat(pixels[:, :, :1], 3, axis=2)
    return np.ascontiguousarray(pixels[:, :, :3])


def grey(pixels: np.ndarray) -> np.ndarray:
    if pixels.shape[2] == 1:
        return pixels[:, :, 0].astype(np.float64)
    return pixels[:, :, :3].astype(np.float64) @ np.asarray(GREY_BGR)


def dct_matrix(n: int) -> np.ndarray:
    k = np.arange(n)
    return np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))


def perceptual_hash(pixels: np.ndarray) -> int:
    """Signed 64-bit hash: signs of the low DCT block against its median."""
    small = grey(pixels)
    small = lanczos_weights(small.shape[0], HASH_SIDE) @ small @ lanczos_weights(small.shape[1], HASH_SIDE).T
    basis = dct_matrix(HASH_SIDE)
    block = (basis @ small @ basis.T)[:HASH_BLOCK, :HASH_BLOCK]
    bits = (block > np.median(block)).reshape(-1)
    return int(np.packbits(bits).view(">i8")[0])


def from_bytes(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
