"""Places along a Hilbert curve in any number of dimensions."""

import numpy as np


def hilbert_keys(cells, bits):
    """Place along the curve of each row of ``cells`` (whole numbers of ``bits`` bits, one column per dimension).

    Neighbouring places are neighbouring cells: they differ by one in one dimension. Rows times bits must fit 63 bits.
    The curve is walked bit by bit from the coarsest: at each level the cell's half-space bits, read
    as a Gray code, are the next digit, and the finer levels are reflected and turned to fit.
    """
    axes = [np.array(cells[:, d], np.uint64) for d in range(cells.shape[1])]
    d = len(axes)
    level = 1 << (bits - 1)
    while level > 1:
        bit, finer = np.uint64(level), np.uint64(level - 1)
        for i in range(d):
            upper = (axes[i] & bit) != 0
            swap = np.where(upper, np.uint64(0), (axes[0] ^ axes[i]) & finer)
            axes[0] = np.where(upper, axes[0] ^ finer, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
        level >>= 1
    for i in range(1, d):
        axes[i] = axes[i] ^ axes[i - 1]
    turn = np.zeros_like(axes[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where((axes[-1] & np.uint64(level)) != 0, turn ^ np.uint64(level - 1), turn)
        level >>= 1
    axes = [a ^ turn for a in axes]
    keys = np.zeros_like(axes[0])
    for b in range(bits - 1, -1, -1):
        for a in axes:
            keys = (keys << np.uint64(1)) | ((a >> np.uint64(b)) & np.uint64(1))
    return keys.astype(np.int64)
