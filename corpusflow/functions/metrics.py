"""Columns computed per training step: learning rate, throughput, utilisation."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Fixed value: peak rate in FLOP/s that utilisation is measured against.
PEAK_FLOPS = 312e12


@dataclass(frozen=True)
class ModelShape:
    """Sizes of the network whose run is analysed."""

    n_layer: int = 12
    n_head: int = 12
    n_embd: int = 768
    block_size: int = 1024
    vocab_size: int = 50304
    bias: bool = False

    def parameters(self) -> int:
        """Weights without the position table, in closed form."""
        e, per_layer = self.n_embd, 12 * self.n_embd**2 + 2 * self.n_embd
        final = e
        if self.bias:
            per_layer += 11 * e
            final += e
        return self.vocab_size * e + self.n_layer * per_layer + final

    def flops_per_token(self) -> int:
        head = self.n_embd // self.n_head
        return 6 * self.parameters() + 12 * self.n_layer * self.n_head * head * self.block_size


@dataclass(frozen=True)
class BatchShape:
    """How many sequences one iteration consumes."""

    gas: int = 1
    world: int = 1
    batch: int = 12
    block: int = 1024

    @property
    def tokens_per_iter(self) -> int:
        return self.gas * self.world * self.batch * self.block

    @property
    def samples_per_iter(self) -> int:
        # the batch size is not a factor here: a sample is one micro-batch of one device
        return self.gas * self.world


def lr_at(step: str | Column, lr: float, min_lr: float, warmup: int, decay: int) -> Column:
    """Linear warm-up from zero, cosine decay, then the floor ``min_lr``."""
    step = F.col(step) if isinstance(step, str) else step
    span = F.lit(float(decay - warmup))
    cosine = F.lit(0.5) * (1.0 + F.cos(F.lit(math.pi) * (step - warmup) / span))
    rate = F.when(step > decay, F.lit(min_lr)).otherwise(F.lit(min_lr) + cosine * (lr - min_lr))
    return F.when(step < warmup, F.lit(lr) * step / F.lit(float(max(warmup, 1)))).otherwise(rate)


def throughput(dt: str | Column, shape: BatchShape) -> dict[str, Column]:
    """Rates per second in total and per device; a step of no duration has none."""
    dt = F.col(dt) if isinstance(dt, str) else dt
    seconds = F.nullif(dt, F.lit(0.0))
    tokens, samples = F.lit(float(shape.tokens_per_iter)) / seconds, F.lit(float(shape.samples_per_iter)) / seconds
    return {
        "tokens_per_sec": tokens,
        "samples_per_sec": samples,
        "tokens_per_sec_per_gpu": tokens / shape.world,
        "samples_per_sec_per_gpu": samples / shape.world,
    }


def loss_total(loss: str | Column, gas: int) -> Column:
    """Loss of the whole iteration from the mean over its micro-steps."""
    return (F.col(loss) if isinstance(loss, str) else loss) * gas


def mfu(dt: str | Column, model: ModelShape, passes: int) -> Column:
    """Share of the peak FLOP rate reached by ``passes`` forward-backward passes in ``dt`` seconds."""
    dt = F.col(dt) if isinstance(dt, str) else dt
    flops = float(model.flops_per_token() * model.block_size * passes)
    return F.lit(flops) / F.nullif(dt, F.lit(0.0)) / F.lit(PEAK_FLOPS)
