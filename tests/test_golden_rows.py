"""Golden rows of each generated table (seed 7), worked out apart from the library's rules."""

import datetime as dt
from decimal import Decimal

import pytest

from saasmart.sources import synth

USERS = [
    (1, 'user1@outlook.com', 'Bob Smith 1', 'free', '2025-03-26', 'GB'),
    (2, 'user2@company.io', 'Carlos Garcia 2', 'free', '2024-12-19', 'DE'),
    (3, 'user3@fastmail.com', 'Diana Chen 3', 'free', '2024-09-13', 'CA'),
    (4, 'user4@proton.me', 'Erik Larsson 4', 'free', '2024-06-08', 'AU'),
    (5, 'user5@gmail.com', 'Fatima Al-Rashid 5', 'pro', '2024-03-03', 'FR'),
    (6, 'user6@outlook.com', 'Grace Kim 6', 'pro', '2023-11-27', 'JP'),
    (7, 'user7@company.io', 'Hiroshi Tanaka 7', 'pro', '2023-08-22', 'BR'),
    (8, 'user8@fastmail.com', 'Isabella Rossi 8', 'enterprise', '2025-05-16', 'US'),
    (9, 'user9@proton.me', "James O'Brien 9", 'enterprise', '2025-02-08', 'GB'),
    (10, 'user10@gmail.com', 'Katarina Novak 10', 'free', '2024-11-03', 'DE'),
    (11, 'user11@outlook.com', 'Liam Patel 11', 'free', '2024-07-29', 'CA'),
    (1499, 'user1499@proton.me', 'Liam Patel 99', 'enterprise', '2025-02-18', 'CA'),
]
EVENTS = [
    (350001, 2, 'upgrade', '2025-10-01 00:05:24', '{"from_plan": "free", "to_plan": "pro"}'),
    (350002, 3, 'downgrade', '2025-10-01 00:10:41', '{"from_plan": "enterprise", "to_plan": "free"}'),
    (350003, 4, 'feature_use', '2025-10-01 00:15:58', '{"feature": "invite_member"}'),
    (350004, 5, 'logout', '2025-10-01 00:21:15', '{"session_duration_sec": 11}'),
    (350005, 6, 'page_view', '2025-10-01 00:26:32', '{"page": "/dashboard", "referrer": "https://google.com"}'),
    (350006, 7, 'signup', '2025-10-01 00:31:49', '{"source": "referral"}'),
    (350007, 8, 'upgrade', '2025-10-01 00:37:06', '{"from_plan": "free", "to_plan": "pro"}'),
    (350008, 9, 'downgrade', '2025-10-01 00:42:23', '{"from_plan": "enterprise", "to_plan": "free"}'),
    (350009, 10, 'feature_use', '2025-10-01 00:47:40', '{"feature": "export_csv"}'),
    (350010, 11, 'logout', '2025-10-01 00:52:57', '{"session_duration_sec": 17}'),
    (350011, 12, 'page_view', '2025-10-01 00:58:14', '{"page": "/settings", "referrer": "direct"}'),
    (351499, 1500, 'page_view', '2025-10-06 11:59:50', '{"page": "/pricing", "referrer": "direct"}'),
]
INVOICES = [
    (3501, 2, '57.99', 'USD', 'paid', '2026-02-16', '2026-02-24'),
    (3502, 3, '217.99', 'USD', 'paid', '2025-12-29', '2026-01-07'),
    (3503, 4, '14.99', 'USD', 'pending', '2025-11-10', None),
    (3504, 5, '15.49', 'USD', 'failed', '2026-03-21', None),
    (3505, 6, '15.99', 'USD', 'refunded', '2026-01-31', '2026-02-12'),
    (3506, 7, '62.99', 'USD', 'paid', '2025-12-13', '2025-12-26'),
    (3507, 8, '227.99', 'USD', 'paid', '2025-10-25', '2025-10-25'),
    (3508, 9, '17.49', 'USD', 'paid', '2026-03-05', '2026-03-06'),
    (3509, 10, '17.99', 'USD', 'paid', '2026-01-15', '2026-01-17'),
    (3510, 11, '18.49', 'USD', 'paid', '2025-11-27', '2025-11-30'),
    (3511, 12, '67.99', 'USD', 'paid', '2025-10-09', '2025-10-13'),
    (4999, 1500, '12.99', 'USD', 'paid', '2026-03-26', '2026-04-03'),
]
TICKETS = [
    (701, 2, 'Cannot export data', 'low', 'open', '2025-12-20', None),
    (702, 3, 'Billing discrepancy', 'medium', 'in_progress', '2026-03-03', None),
    (703, 4, 'Login issues after upgrade', 'high', 'resolved', '2025-11-16', '2025-11-20'),
    (704, 5, 'Feature request: dark mode', 'critical', 'closed', '2026-01-28', '2026-02-02'),
    (705, 6, 'API rate limit too low', 'low', 'open', '2025-10-13', None),
    (706, 7, 'Dashboard not loading', 'medium', 'in_progress', '2025-12-25', None),
    (707, 8, 'Team invitation failed', 'high', 'resolved', '2026-03-08', '2026-03-09'),
    (708, 9, 'Data sync delay', 'critical', 'closed', '2025-11-21', '2025-11-23'),
    (709, 10, 'Cannot export data', 'low', 'open', '2026-02-02', None),
    (710, 11, 'Billing discrepancy', 'medium', 'in_progress', '2025-10-18', None),
    (711, 12, 'Login issues after upgrade', 'high', 'resolved', '2025-12-30', '2026-01-04'),
    (2199, 1500, 'Login issues after upgrade', 'high', 'resolved', '2026-03-24', '2026-03-26'),
]


def _plain(row):
    out = []
    for v in row:
        if isinstance(v, dt.datetime):
            v = str(v) if v.time() != dt.time() else (str(v.date()), str(v))
        out.append(str(v) if isinstance(v, Decimal) else v)
    return tuple(out)


def _same(got, want):
    return all(g == w or isinstance(g, tuple) and w in g for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("name, want", [("users", USERS), ("events", EVENTS), ("invoices", INVOICES), ("support_tickets", TICKETS)])
def test_golden_rows(spark, name, want):
    df = synth.users(spark) if name == "users" else getattr(synth, name)(spark, [7]).drop("batch")
    got = {r.id: _plain(r) for r in df.where(df.id.isin([w[0] for w in want])).collect()}
    assert len(got) == len(want)
    for w in want:
        assert _same(got[w[0]], w), (got[w[0]], w)
