"""A gated recurrent language model in numpy with a class-factored softmax.

Words are numbered 0 to ``size - 1`` by frequency, 0 being a text's end; ``size`` stands for every
other word and is a class of its own. The chance of a word is that of its class times its own in the
class. A text starts from the zero state after a text's end, and its state goes on from window to
window, so its whole likelihood is exact, however long it is.

Inside, states are rows, one per step and lane, and the gates and the candidate have arrays of their
own: every operation of a step then runs over memory in one go, and a word's weights are copied whole.
Logits are columns. The last unit of hidden rows is 1, which takes the biases of the softmax along.
"""

from __future__ import annotations

import math

import numpy as np

#: Hidden units, words of a class, steps of a window, texts that run side by side.
HIDDEN, CLASS_WORDS, WINDOW, LANES = 24, 32, 32, 1024
#: Training: texts side by side at most, windows of each at least, passes over all texts, step size.
TRAIN_LANES, LANE_WINDOWS, ROUNDS, RATE = 512, 8, 2, 0.01
#: Commonest words whose slopes are summed step by step, columns of a softmax at once, and the logits' size up
#: to which no maximum is taken off before ``exp``.
MARKED, COLUMNS, SAFE = 14, 512, 60.0


def _small(weights: np.ndarray) -> bool:
    """Whether logits stay small for states from -1 to 1 (``weights``: units and the bias in the second last place)."""
    return float(np.abs(weights).sum(-2).max()) < SAFE


def _exp_logits(logits: np.ndarray, chosen: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``exp`` of new logits [batch, word, column], in place: their sums, the logits at ``chosen`` [batch, column], and
    the flat places of these. Logits are less the largest one of a column unless all are ``small``."""
    if not small:
        logits -= logits.max(1, keepdims=True)
    batch, words, columns = logits.shape
    at = chosen * columns
    at += np.arange(columns)
    at += (np.arange(batch) * (words * columns))[:, None]
    own = logits.reshape(-1).take(at)
    np.exp(logits, out=logits)
    return logits.sum(1), own, at


def _summed(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and the sums of their rows; ``keys`` are sorted, and behind the rows is one of 0. Neighbours of a
    key are added in pairs until none are left."""
    while len(keys):
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        if len(heads) == len(keys):
            break
        even = np.flatnonzero((np.arange(len(keys)) - np.repeat(heads, np.diff(heads, append=len(keys)))) % 2 == 0)
        after = np.where(np.diff(even, append=len(keys)) == 2, even + 1, len(keys))
        kept = np.empty((len(even) + 1, rows.shape[1]), rows.dtype)
        np.take(rows, even, axis=0, out=kept[:-1], mode="clip")
        kept[:-1] += np.take(rows, after, axis=0)
        kept[-1] = 0
        keys, rows = keys[even], kept
    return keys, rows[:-1]


def _hidden(states: np.ndarray) -> np.ndarray:
    """Rows of states with a 1 behind."""
    out = np.empty((len(states), HIDDEN + 1), states.dtype)
    out[:, :-1], out[:, -1] = states, 1
    return out


class Recurrent:
    def __init__(self, size: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.size = size
        self.classes = -(-size // CLASS_WORDS)
        h = HIDDEN

        def drawn(*shape: int) -> np.ndarray:
            return rng.normal(0, 0.08, shape).astype(np.float32)

        def parts(rows: int) -> np.ndarray:
            return np.ascontiguousarray(drawn(rows, 3 * h).reshape(rows, 3, h).transpose(1, 0, 2))

        self.weights = {
            "input": parts(size + 1),  # update, reset, candidate
            "state": parts(h),
            "bias": np.zeros(h, np.float32),  # of the candidate's state part
            "class": drawn(h, self.classes + 1),
            "class_bias": np.zeros(self.classes + 1, np.float32),
            "word": drawn(self.classes, h, CLASS_WORDS),
            "word_bias": np.zeros((self.classes, CLASS_WORDS), np.float32),
        }
        spare = self.classes * CLASS_WORDS - size
        if spare:
            self.weights["word_bias"][-1, -spare:] = -30  # places without a word

    def set_unigrams(self, counts: np.ndarray, others: float) -> None:
        """Start from the words' counts (and that of all other words) as biases."""
        padded = np.full(self.classes * CLASS_WORDS, 1e-9)
        padded[: self.size] = counts + 0.5
        padded = padded.reshape(self.classes, CLASS_WORDS)
        mass = np.append(padded.sum(1), others + 0.5)
        self.weights["class_bias"] = np.log(mass / mass.sum()).astype(np.float32)
        self.weights["word_bias"] = np.log(padded / padded.sum(1, keepdims=True)).astype(np.float32)

    def step(self, token: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state [lane, unit], and what its gradient needs."""
        u, n, after = (np.empty((*k, *state.shape), state.dtype) for k in ((3,), (), ()))
        self._advance(self._ahead(len(state)), token, state, u, n, after)
        return after, *u, n

    def _ahead(self, lanes: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights from the state before to a step's gates, negated, and to its candidate's state part, and that
        part's bias for each lane."""
        w = self.weights
        return w["state"] * np.array([-1, -1, 1], w["state"].dtype)[:, None, None], np.tile(w["bias"], (lanes, 1))

    def _advance(self, ahead: tuple, token: np.ndarray, begin: np.ndarray, u: np.ndarray, n: np.ndarray, after: np.ndarray) -> None:
        """A step from states ``begin`` (``ahead``: see ``_ahead``): its update and reset gates and its candidate's
        state part go to ``u``, its candidate to ``n`` and the next states to ``after``."""
        weights, bias, gates = ahead[0], ahead[1][: len(begin)], u[:2]
        x = np.take(self.weights["input"], token, axis=1, mode="clip")
        np.matmul(begin, weights, out=u)
        u[2] += bias
        gates -= x[:2]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(u[1], u[2], out=n)
        n += x[2]
        np.tanh(n, out=n)
        change = np.subtract(begin, n, out=x[0])
        change *= u[0]
        np.add(change, n, out=after)

    def _by_class(self, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, slice]]]:
        """Places of the words' targets class by class, pieces of about equal length side by side: the places,
        which of them count (a piece's last one fills it up to its batch's length), and of each batch the classes
        of its pieces and its slice of the places."""
        inside = np.flatnonzero(target < self.size)
        if not len(inside):
            return inside, np.zeros(0, bool), []
        group = target[inside] // CLASS_WORDS
        inside = inside[np.argsort(group.astype(np.uint16), kind="stable")]
        counts = np.bincount(group, minlength=self.classes)
        parts = -(-counts // COLUMNS)
        kind = np.repeat(np.arange(self.classes), parts)
        nth = np.arange(len(kind)) - np.repeat(np.cumsum(parts) - parts, parts)
        low, high = (counts[kind] * k // parts[kind] for k in (nth, nth + 1))
        first, length = (np.cumsum(counts) - counts)[kind] + low, high - low
        order = np.argsort(-length, kind="stable")
        kind, first, length = kind[order], first[order], length[order]
        at, counted, batches, k, size = [], [], [], 0, 0
        while k < len(kind):
            longest = int(length[k])
            end = min(int(np.searchsorted(-length, -0.75 * longest, side="right")), k + max(1, 4 * COLUMNS // longest))
            column, own = np.arange(longest), length[k:end, None]
            at.append((first[k:end, None] + np.minimum(column, own - 1)).ravel())
            counted.append((column < own).ravel())
            batches.append((kind[k:end], slice(size, size + len(at[-1]))))
            k, size = end, size + len(at[-1])
        return inside[np.concatenate(at)], np.concatenate(counted), batches

    def _class_weights(self) -> np.ndarray:
        """Weights [unit and bias, class] of the softmax over classes."""
        return np.vstack([self.weights["class"], self.weights["class_bias"]])

    def _word_weights(self) -> np.ndarray:
        """Weights [class, unit and bias, word] of the softmax in each class."""
        return np.concatenate([self.weights["word"], self.weights["word_bias"][:, None]], 1)

    def log_probabilities(self, hidden: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithms of the targets' chances after states [row, unit]; for other words that of their class."""
        return self._logs(_hidden(hidden), target)

    def _logs(self, hidden: np.ndarray, target: np.ndarray) -> np.ndarray:
        """``log_probabilities`` for hidden rows."""
        group = np.where(target < self.size, target // CLASS_WORDS, self.classes)
        out = np.empty(len(target))
        weights = self._class_weights()
        small = _small(weights)
        for k in range(0, len(target), COLUMNS):
            s = slice(k, k + COLUMNS)
            sums, own, _ = _exp_logits((weights.T @ hidden[s].T)[None], group[None, s], small)
            out[s] = (own - np.log(sums))[0]
        places, counted, batches = self._by_class(target)
        rows, inside, logs = np.take(hidden, places, axis=0), target[places] % CLASS_WORDS, np.empty(len(places))
        weights = self._word_weights()
        small = _small(weights)
        for kind, s in batches:
            shape = len(kind), -1
            part = rows[s].reshape(*shape, HIDDEN + 1)
            sums, own, _ = _exp_logits(weights[kind].transpose(0, 2, 1) @ part.transpose(0, 2, 1), inside[s].reshape(shape), small)
            logs[s] = (own - np.log(sums)).ravel()
        out[places[counted]] += logs[counted]
        return out

    def text_scores(self, texts: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood of each text (word numbers, its end included)."""
        scores, ahead = np.zeros(len(texts)), self._ahead(min(LANES, len(texts)))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for first in range(0, len(order), LANES):
            lanes = order[first : first + LANES]
            lengths = np.array([len(texts[i]) for i in lanes])
            state = np.zeros((len(lanes), HIDDEN), np.float32)
            before = np.zeros(len(lanes), np.int64)
            start, longest = 0, int(lengths[0])
            while start < longest:
                running = int(np.searchsorted(-lengths, -start))  # texts longer than start
                width = min(max(WINDOW, LANES * WINDOW // running), longest - start)  # few texts take longer windows
                window = np.zeros((running, width + 1), np.int64)  # the token before, then the window's
                window[:, 0] = before[:running]
                for row, i in enumerate(lanes[:running]):
                    part = texts[i][start : start + width]
                    window[row, 1 : len(part) + 1] = part
                active = np.searchsorted(-lengths[:running], -(start + np.arange(width))).tolist()
                edges = np.concatenate([[0], np.cumsum(active)]).tolist()
                states = np.empty((edges[-1], HIDDEN), np.float32)
                u, own = np.empty((3, running, HIDDEN), np.float32), np.empty((running, HIDDEN), np.float32)
                for t, n in enumerate(active):
                    part = states[edges[t] : edges[t + 1]]
                    self._advance(ahead, window[:n, t], state[:n], u[:, :n], own[:n], part)
                    state = part
                before = window[:, width]
                logs = self._logs(_hidden(states), np.concatenate([window[:n, t + 1] for t, n in enumerate(active)]))
                lane = np.concatenate([np.arange(n) for n in active])
                scores[lanes[:running]] += np.bincount(lane, logs, minlength=running)
                start += width
        return scores

    def loss_and_slopes(self, tokens: np.ndarray, targets: np.ndarray, state: np.ndarray) -> tuple[float, dict, np.ndarray]:
        """Mean loss of a window [lane, step], its gradient cut at the window's start, and the last state.
        A text's end as input resets the state."""
        w, h = self.weights, HIDDEN
        lanes, steps = tokens.shape
        kind = w["state"].dtype
        words, target = np.ascontiguousarray(tokens.T), targets.T.ravel()
        total = len(target)
        ended = [np.flatnonzero(step == 0) for step in words]
        # of each step the states before and after, and what _advance finds
        begin, states, n = (np.empty((steps, lanes, h), kind) for _ in range(3))
        u, ahead = np.empty((steps, 3, lanes, h), kind), self._ahead(lanes)
        for t in range(steps):
            begin[t] = states[t - 1] if t else state
            begin[t][ended[t]] = 0
            self._advance(ahead, words[t], begin[t], u[t], n[t], states[t])
        hidden, slopes = _hidden(states.reshape(total, h)), {}
        loss, slopes["class"], slopes["class_bias"], back = self._class_slopes(hidden, target)
        more, slopes["word"], slopes["word_bias"], pulled, source = self._word_slopes(hidden, target)
        del hidden
        # from now on a step's gates and parts give their places to their slopes
        common = min(MARKED, self.size)
        marks = np.zeros((steps, common + 2, lanes), kind)  # for sums over each of the commonest words, all lanes, other words
        marks[:, -2] = 1
        marks[:, -1] = words == self.size
        step, lane = np.nonzero(words < common)
        marks[step, words[step, lane], lane] = 1
        state_sums, sums, own_sums = (np.zeros(shape, kind) for shape in ((3, h, h), (3, common + 2, h), (common + 2, h)))
        carried, d, a = np.zeros((lanes, h), kind), np.empty((lanes, h), kind), np.empty((lanes, h), kind)
        back, source, through = back.reshape(steps, lanes, h), source.reshape(steps, lanes), w["state"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            (z, r, inner), own = u[t], n[t]
            np.take(pulled, source[t], axis=0, out=d, mode="clip")
            d += back[t]
            d += carried
            np.multiply(d, z, out=carried)
            d -= carried
            np.subtract(states[t], own, out=a)
            np.multiply(d, a, out=z)
            np.multiply(own, own, out=a)
            np.subtract(1, a, out=a)
            np.multiply(d, a, out=own)
            np.multiply(own, inner, out=d)
            np.multiply(own, r, out=inner)
            d *= r
            np.multiply(d, r, out=a)
            np.subtract(d, a, out=r)
            for part in u[t] @ through:
                carried += part
            carried[ended[t]] = 0
            state_sums += begin[t].T @ u[t]
            sums += marks[t] @ u[t]
            own_sums += marks[t] @ own
        slopes["state"], slopes["bias"] = state_sums, sums[2, -2].copy()
        slopes["input"] = np.zeros_like(w["input"])
        rest = np.flatnonzero((words >= common) & (words < self.size))
        word = words.ravel()[rest]
        order = np.argsort(word.astype(np.uint16), kind="stable")
        word, rest = word[order], rest[order]
        step, rows = rest // lanes * lanes, np.zeros((len(rest) + 1, 3 * h), kind)
        for k in range(2):
            rows[:-1, k * h : (k + 1) * h] = np.take(u.reshape(-1, h), rest + 2 * step + k * lanes, axis=0)
        rows[:-1, 2 * h :] = np.take(n.reshape(-1, h), rest, axis=0)
        word, rows = _summed(word, rows)
        slopes["input"][:, word] = rows.reshape(-1, 3, h).swapaxes(0, 1)
        sums[2] = own_sums
        slopes["input"][:, :common] = sums[:, :common]
        slopes["input"][:, -1] = sums[:, -1]
        for name in w:
            slopes[name] /= total
        return (loss + more) / total, slopes, states[-1]

    def _class_slopes(self, hidden: np.ndarray, target: np.ndarray) -> tuple:
        """Summed loss of the softmax over classes and its gradients by weights, bias and each hidden row."""
        group = np.where(target < self.size, target // CLASS_WORDS, self.classes)
        weights = self._class_weights()
        loss, slopes, small = 0.0, np.zeros_like(weights.T), _small(weights)
        back = np.empty((len(hidden), HIDDEN), hidden.dtype)
        for k in range(0, len(target), COLUMNS):
            s = slice(k, k + COLUMNS)
            pull = weights.T @ hidden[s].T
            sums, own, chosen = _exp_logits(pull[None], group[None, s], small)
            loss += float((np.log(sums) - own).sum(dtype=np.float64))
            pull *= np.reciprocal(sums)
            pull.reshape(-1)[chosen[0]] -= 1
            slopes += pull @ hidden[s]
            np.matmul(pull.T, weights[:-1].T, out=back[s])
        return loss, slopes[:, :-1].T.copy(), slopes[:, -1].copy(), back

    def _word_slopes(self, hidden: np.ndarray, target: np.ndarray) -> tuple:
        """Summed loss of the softmax in each class and its gradients by weights and bias; those by hidden rows,
        and which of these each target has (the last is 0, for the targets without a word)."""
        places, counted, batches = self._by_class(target)
        weights = self._word_weights()
        rows, inside = np.take(hidden, places, axis=0), target[places] % CLASS_WORDS
        loss, found, small = 0.0, [], _small(weights)
        pulled = np.empty((len(places) + 1, HIDDEN), hidden.dtype)
        pulled[-1] = 0
        for kind, s in batches:
            shape = len(kind), -1
            own_weights, real = weights[kind].transpose(0, 2, 1), counted[s].reshape(shape).astype(hidden.dtype)
            part = rows[s].reshape(*shape, HIDDEN + 1)
            pull = own_weights @ part.transpose(0, 2, 1)
            sums, own, chosen = _exp_logits(pull, inside[s].reshape(shape), small)
            loss += float(((np.log(sums) - own) * real).sum(dtype=np.float64))
            pull *= (real / sums)[:, None]
            pull.reshape(-1)[chosen] -= real
            found.append(pull @ part)
            np.matmul(pull.transpose(0, 2, 1), own_weights[..., :-1], out=pulled[s].reshape(*shape, HIDDEN))
        slopes = np.zeros_like(weights)
        if batches:
            kind = np.concatenate([k for k, _ in batches])
            order = np.argsort(kind, kind="stable")
            sums = np.concatenate(found)[order].reshape(len(order), -1)
            kind, sums = _summed(kind[order], np.concatenate([sums, np.zeros_like(sums[:1])]))
            slopes[kind] = sums.reshape(-1, CLASS_WORDS, HIDDEN + 1).transpose(0, 2, 1)
        source = np.full(len(target), len(places))
        source[places[counted]] = np.flatnonzero(counted)
        return loss, slopes[:, :-1].copy(), slopes[:, -1].copy(), pulled, source

    def train(self, texts: list[np.ndarray], rounds: int = ROUNDS) -> list[float]:
        """Truncated backpropagation through time over all texts, with Adam; returns the mean losses."""
        stream = np.concatenate([np.zeros(1, np.int64), *texts]) if texts else np.zeros(1, np.int64)
        pace, losses = Adam(self), []
        for k in range(rounds):
            sums = self.follow(stream, pace, RATE * (1 - 0.9 * k / rounds))
            if not sums:
                return []
            losses.append(float(np.mean(sums)))
        return losses

    def follow(self, stream: np.ndarray, pace: Adam, rate: float, most: int = TRAIN_LANES) -> list[float]:
        """One pass over a stream of texts, cut into lanes that run side by side; returns the windows' losses."""
        lanes = max(1, min(most, (len(stream) - 1) // (LANE_WINDOWS * WINDOW)))
        steps = (len(stream) - 1) // lanes
        tokens = stream[: lanes * steps].reshape(lanes, steps)
        targets = stream[1 : lanes * steps + 1].reshape(lanes, steps)
        state = np.zeros((lanes, HIDDEN), np.float32)
        losses = []
        for start in range(0, steps, WINDOW):
            end = min(start + WINDOW, steps)
            loss, slopes, state = self.loss_and_slopes(tokens[:, start:end], targets[:, start:end], state)
            losses.append(loss)
            pace.update(self, slopes, rate)
        left = len(stream) - 1 - lanes * steps
        if left:  # fewer tokens than lanes, as one lane more
            tail = stream[-left - 1 :][None]
            loss, slopes, _ = self.loss_and_slopes(tail[:, :-1], tail[:, 1:], np.zeros((1, HIDDEN), np.float32))
            losses.append(loss)
            pace.update(self, slopes, rate * left / (lanes * WINDOW))
        return losses

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.weights.values()])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for name, x in self.weights.items():
            self.weights[name] = values[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size


class Adam:
    """Step sizes from running means of the gradient and its square, the gradient cut to length 1."""

    def __init__(self, model: Recurrent):
        self.first = {k: np.zeros_like(v) for k, v in model.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in model.weights.items()}
        self.updates = 0

    def update(self, model: Recurrent, slopes: dict, rate: float) -> None:
        self.updates += 1
        size = math.sqrt(sum(float(np.vdot(s, s)) for s in slopes.values()))
        cut, spread = min(1.0, 1.0 / (size + 1e-9)), 1 / math.sqrt(1 - 0.99**self.updates)
        for k, s in slopes.items():
            first, second = self.first[k], self.second[k]
            s = s * cut
            step = s - first
            step *= 0.1
            first += step
            s *= s
            s -= second
            s *= 0.01
            second += s
            np.sqrt(second, out=s)
            s *= spread
            s += 1e-6
            np.divide(first, s, out=s)
            s *= rate / (1 - 0.9**self.updates)
            model.weights[k] -= s
