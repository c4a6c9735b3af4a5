"""The same queries as SQL for DuckDB, written from the definitions.

The SQL joins in the order of the definition and numbers customers one by one where
the operators take other ways, so a match checks those ways too.
"""

from __future__ import annotations

_VIEWS = {
    "ticket": """
    SELECT o_custkey AS customerid, l_suppkey AS storeid, o_orderpriority AS cardtype,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS datekey,
           o_orderkey AS ticketid, l_partkey AS productid,
           CAST(l_extendedprice AS DECIMAL(18,2))
             * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))) AS extendedamount,
           CASE WHEN l_partkey % 23 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END
             AS originalamount,
           CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))
             AS totaldiscount,
           l_quantity AS quantity
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN (VALUES (1), (2)) AS copies (copy) ON copy = 1 OR l_orderkey % 10 = 0""",
    "line": "SELECT DISTINCT * FROM ticket",
    "rfm": """
    SELECT customerid,
           CAST(min(date_diff('day', CAST(datekey AS DATE),
                              (SELECT max(CAST(datekey AS DATE)) FROM ticket))) AS INTEGER)
             AS recency,
           count(DISTINCT ticketid) AS frequency,
           CAST(sum(extendedamount) AS DOUBLE) AS monetary
    FROM line
    GROUP BY customerid""",
    "bound": """
    SELECT quantile_disc(recency, 0.95) AS r, quantile_disc(frequency, 0.99) AS f,
           quantile_disc(monetary, 0.99) AS m
    FROM rfm""",
    "trimmed": """
    SELECT rfm.* FROM rfm, bound WHERE recency < r AND frequency < f AND monetary < m""",
    "outlier": """
    SELECT rfm.* FROM rfm, bound WHERE recency >= r OR frequency >= f OR monetary >= m""",
    "threshold": """
    SELECT 'recency' AS metric, CAST(quantile_disc(recency, 0.25) AS DOUBLE) AS q1,
           CAST(quantile_disc(recency, 0.5) AS DOUBLE) AS q2,
           CAST(quantile_disc(recency, 0.75) AS DOUBLE) AS q3
    FROM trimmed
    UNION ALL
    SELECT 'frequency', CAST(quantile_disc(frequency, 0.25) AS DOUBLE),
           CAST(quantile_disc(frequency, 0.5) AS DOUBLE),
           CAST(quantile_disc(frequency, 0.75) AS DOUBLE)
    FROM trimmed
    UNION ALL
    SELECT 'monetary', quantile_disc(monetary, 0.25), quantile_disc(monetary, 0.5),
           quantile_disc(monetary, 0.75)
    FROM trimmed""",
    "grade": """
    SELECT rfm.*,
           CASE WHEN recency > r.q3 THEN 4 WHEN recency > r.q2 THEN 3
                WHEN recency > r.q1 THEN 2 ELSE 1 END AS r_quartile,
           CASE WHEN frequency > f.q3 THEN 1 WHEN frequency > f.q2 THEN 2
                WHEN frequency > f.q1 THEN 3 ELSE 4 END AS f_quartile,
           CASE WHEN monetary > m.q3 THEN 1 WHEN monetary > m.q2 THEN 2
                WHEN monetary > m.q1 THEN 3 ELSE 4 END AS m_quartile
    FROM rfm
    JOIN threshold r ON r.metric = 'recency'
    JOIN threshold f ON f.metric = 'frequency'
    JOIN threshold m ON m.metric = 'monetary'""",
    "scored": """
    SELECT *, CAST(r_quartile AS VARCHAR) || CAST(f_quartile AS VARCHAR)
              || CAST(m_quartile AS VARCHAR) AS rfm_score
    FROM grade""",
    "scale": """
    SELECT count(*) AS n, CAST(ceil(count(*) / 6.0) AS BIGINT) AS size,
           avg(r_quartile) AS rm, stddev_samp(r_quartile) AS rs,
           avg(f_quartile) AS fm, stddev_samp(f_quartile) AS fs,
           avg(m_quartile) AS mm, stddev_samp(m_quartile) AS ms
    FROM scored""",
    "scaled": """
    SELECT customerid, rfm_score, (r_quartile - rm) / rs AS r, (f_quartile - fm) / fs AS f,
           (m_quartile - mm) / ms AS m
    FROM scored, scale""",
    "place": """
    SELECT r_quartile, f_quartile, m_quartile, size,
           row_number() OVER (ORDER BY r_quartile) - 1 AS r_place,
           row_number() OVER (ORDER BY f_quartile) - 1 AS f_place,
           row_number() OVER (ORDER BY m_quartile) - 1 AS m_place
    FROM scored, scale""",
    "seed": """
    SELECT r.chunk, r_quartile, f_quartile, m_quartile
    FROM (SELECT CAST(r_place // size AS INTEGER) AS chunk,
                 quantile_disc(r_quartile, 0.5) AS r_quartile FROM place GROUP BY 1) r
    JOIN (SELECT CAST(f_place // size AS INTEGER) AS chunk,
                 quantile_disc(f_quartile, 0.5) AS f_quartile FROM place GROUP BY 1) f
      ON r.chunk = f.chunk
    JOIN (SELECT CAST(m_place // size AS INTEGER) AS chunk,
                 quantile_disc(m_quartile, 0.5) AS m_quartile FROM place GROUP BY 1) m
      ON r.chunk = m.chunk""",
    "point": """
    SELECT r, f, m, count(*) AS weight FROM scaled GROUP BY r, f, m""",
    # Lloyd iterations over the distinct points: the centres of a step as one list. A
    # centre without points stays; the last step moves no centre by more than 1e-4.
    "fit": """
    SELECT 0 AS step, TRUE AS moving,
           list([(r_quartile - rm) / rs, (f_quartile - fm) / fs, (m_quartile - mm) / ms]
                ORDER BY chunk) AS centers
    FROM seed, scale
    UNION ALL
    SELECT step + 1,
           max(pow(center[1] - centers[k][1], 2) + pow(center[2] - centers[k][2], 2)
               + pow(center[3] - centers[k][3], 2)) > 1e-8,
           list(center ORDER BY k)
    FROM (
      SELECT step, centers, k,
             CASE WHEN sum(mine) = 0 THEN centers[k]
                  ELSE [sum(mine * r) / sum(mine), sum(mine * f) / sum(mine),
                        sum(mine * m) / sum(mine)] END AS center
      FROM (
        SELECT step, centers, k, r, f, m,
               CASE WHEN list_position(distances, list_min(distances)) = k THEN weight ELSE 0 END
                 AS mine
        FROM (
          SELECT step, centers, r, f, m, weight,
                 list_transform(centers, lambda c: round(
                   pow(r - c[1], 2) + pow(f - c[2], 2) + pow(m - c[3], 2), 9)) AS distances
          FROM fit, point
          WHERE moving AND step < 100),
          (VALUES (1), (2), (3), (4), (5), (6)) AS clusters (k))
      GROUP BY step, centers, k)
    GROUP BY step""",
    "measure": """
    SELECT avg(recency) AS rm, stddev_samp(recency) AS rs, avg(frequency) AS fm,
           stddev_samp(frequency) AS fs, avg(monetary) AS mm, stddev_samp(monetary) AS ms
    FROM rfm WHERE recency IS NOT NULL AND frequency IS NOT NULL AND monetary IS NOT NULL""",
    "vector": """
    SELECT rfm.*, (recency - rm) / rs AS r, (frequency - fm) / fs AS f, (monetary - mm) / ms AS m
    FROM rfm, measure
    WHERE recency IS NOT NULL AND frequency IS NOT NULL AND monetary IS NOT NULL""",
    # The same iterations over all customers, each of weight 1, from quantiles as seeds.
    "drift": """
    SELECT 0 AS step, TRUE AS moving,
           list([(r - rm) / rs, (f - fm) / fs, (m - mm) / ms] ORDER BY p) AS centers
    FROM (SELECT unnest([0.08, 0.25, 0.42, 0.58, 0.75, 0.92]) AS p,
                 unnest(quantile_disc(recency, [0.08, 0.25, 0.42, 0.58, 0.75, 0.92])) AS r,
                 unnest(quantile_disc(frequency, [0.08, 0.25, 0.42, 0.58, 0.75, 0.92])) AS f,
                 unnest(quantile_disc(monetary, [0.08, 0.25, 0.42, 0.58, 0.75, 0.92])) AS m
          FROM rfm), measure
    UNION ALL
    SELECT step + 1,
           max(pow(center[1] - centers[k][1], 2) + pow(center[2] - centers[k][2], 2)
               + pow(center[3] - centers[k][3], 2)) > 1e-8,
           list(center ORDER BY k)
    FROM (
      SELECT step, centers, k,
             CASE WHEN sum(mine) = 0 THEN centers[k]
                  ELSE [sum(mine * r) / sum(mine), sum(mine * f) / sum(mine),
                        sum(mine * m) / sum(mine)] END AS center
      FROM (
        SELECT step, centers, k, r, f, m,
               CASE WHEN list_position(distances, list_min(distances)) = k THEN 1 ELSE 0 END AS mine
        FROM (
          SELECT step, centers, r, f, m,
                 list_transform(centers, lambda c:
                   pow(r - c[1], 2) + pow(f - c[2], 2) + pow(m - c[3], 2)) AS distances
          FROM drift, vector
          WHERE moving AND step < 100),
          (VALUES (1), (2), (3), (4), (5), (6)) AS clusters (k))
      GROUP BY step, centers, k)
    GROUP BY step""",
    "named": """
    SELECT * FROM (VALUES (0, 'best'), (1, 'ocassional'), (2, 'loyal'), (3, 'promising'),
                          (4, 'risk'), (5, 'lost')) AS names (prediction, segmento)""",
    "prediction": """
    SELECT rfm.*, named.prediction, named.segmento
    FROM rfm JOIN named ON named.prediction = (customerid // 10) % 6""",
    "sold": """
    SELECT * REPLACE (CASE WHEN customerid % 97 <> 0 THEN customerid END AS customerid)
    FROM ticket""",
    "client": """
    SELECT c_custkey AS customerid,
           CASE WHEN c_custkey % 17 <> 0 THEN CAST(14 + c_custkey % 62 AS INTEGER) END AS age,
           CASE WHEN c_custkey % 9 = 0 THEN 'U' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END
             AS gender
    FROM customer""",
    "store": """
    SELECT s_suppkey AS storeid, CASE WHEN s_suppkey % 11 <> 0 THEN n_name END AS city
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "product": """
    SELECT p_partkey AS productid, p_type AS merchandisegroup,
           CASE WHEN p_partkey % 19 <> 0 THEN p_brand END AS merchandisefamily,
           CASE WHEN p_partkey % 29 <> 0 THEN
                CASE WHEN p_size <= 10 THEN 'SUPERREDUCED' WHEN p_size <= 30 THEN 'REDUCED'
                     ELSE 'GENERAL' END END AS vatdescription,
           CASE WHEN p_partkey % 31 <> 0 THEN p_name END AS article
    FROM part""",
    "brand": "SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS INTEGER) AS k FROM part",
    "class": """
    SELECT CASE WHEN k % 5 <> 0 THEN p_brand END AS merchandisefamily,
           CASE WHEN k % 7 <> 0 AND k % 2 = 0 THEN 'YES' ELSE 'NO' END AS healthy,
           CASE WHEN k % 7 <> 0 AND k % 2 = 1 THEN 'YES' ELSE 'NO' END AS unhealthy
    FROM brand""",
    "dataset": """
    SELECT DISTINCT p.segmento, p.prediction, t.ticketid, t.productid, t.customerid, t.storeid,
           t.originalamount, t.extendedamount, t.quantity, t.datekey, t.cardtype,
           t.totaldiscount, c.age, c.gender, s.city, g.merchandisegroup, g.merchandisefamily,
           g.vatdescription, g.article, k.healthy, k.unhealthy
    FROM prediction p
    LEFT JOIN sold t ON p.customerid = t.customerid
    LEFT JOIN client c ON t.customerid = c.customerid
    LEFT JOIN store s ON t.storeid = s.storeid
    LEFT JOIN product g ON t.productid = g.productid
    LEFT JOIN class k ON g.merchandisefamily = k.merchandisefamily""",
}


def _query(body: str) -> str:
    """``body`` after the views that it needs, in the order of their definition."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        words = set(texts.pop().replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in words & _VIEWS.keys() - needed:
            needed.add(name)
            texts.append(_VIEWS[name])
    views = ",\n".join(f"{name} AS ({text})" for name, text in _VIEWS.items() if name in needed)
    return f"WITH RECURSIVE {views}\n{body}"


def _families(order: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT *, rank() OVER (PARTITION BY segmento ORDER BY product_count {order}) AS rank
      FROM (SELECT segmento, merchandisefamily, count(productid) AS product_count FROM dataset
            WHERE merchandisefamily IS NOT NULL GROUP BY ALL))
    WHERE rank <= 10"""


def _share(rows: str, groups: str) -> str:
    return f"""
    SELECT segmento, {groups},
           CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY segmento) AS DOUBLE) * 100
             AS relative_freq_pct
    FROM (SELECT segmento, {groups}, count(productid) AS n FROM ({rows}) GROUP BY ALL)"""


_BODIES = {
    "ticket_lines": """
    SELECT customerid, storeid, cardtype, datekey AS date, ticketid, productid,
           CAST(sum(extendedamount) AS DOUBLE) AS extendedamount,
           CAST(sum(originalamount) AS DOUBLE) AS originalamount,
           CAST(sum(totaldiscount) AS DOUBLE) AS totaldiscount,
           sum(quantity) AS quantity
    FROM line GROUP BY ALL""",
    "rfm_table": "SELECT * FROM rfm",
    # Both copies of a line have numbers of their own in orders divisible by 20.
    "json_tickets": """
    SELECT customerid, recency, frequency, CAST(paid AS DOUBLE) AS monetary
    FROM rfm
    JOIN (SELECT customerid, sum(extendedamount) AS paid
          FROM (SELECT customerid, extendedamount FROM ticket WHERE ticketid % 20 = 0
                UNION ALL
                SELECT customerid, extendedamount FROM line WHERE ticketid % 20 <> 0)
          GROUP BY customerid) USING (customerid)""",
    "rfm_trim_bounds": """
    SELECT 'recency' AS metric, CAST(r AS DOUBLE) AS bound FROM bound
    UNION ALL SELECT 'frequency', CAST(f AS DOUBLE) FROM bound
    UNION ALL SELECT 'monetary', m FROM bound""",
    "rfm_trimmed": "SELECT * FROM trimmed",
    "rfm_outliers": "SELECT * FROM outlier",
    "rfm_trim_audit": """
    SELECT (SELECT count(*) FROM rfm) AS total, (SELECT count(*) FROM trimmed) AS trimmed,
           (SELECT count(*) FROM outlier) AS outliers,
           (SELECT count(*) FROM rfm
            WHERE recency IS NULL OR frequency IS NULL OR monetary IS NULL) AS null_metrics""",
    "rfm_thresholds": "SELECT * FROM threshold",
    "rfm_scores": "SELECT * FROM scored",
    "score_batch": "SELECT * FROM scored",
    "standardised_scores": """
    SELECT customerid, round(r, 6) AS r_quartile_scaled, round(f, 6) AS f_quartile_scaled,
           round(m, 6) AS m_quartile_scaled
    FROM scaled""",
    "seed_centroids": "SELECT * FROM seed",
    "seed_assignment": """
    SELECT customerid, rfm_score, prediction, segmento,
           '(' || CAST(prediction AS VARCHAR) || ') ' || segmento AS prediction_label
    FROM (
      SELECT customerid, rfm_score, chunk,
             row_number() OVER (
               PARTITION BY customerid
               ORDER BY round(pow(r - (r_quartile - rm) / rs, 2)
                              + pow(f - (f_quartile - fm) / fs, 2)
                              + pow(m - (m_quartile - mm) / ms, 2), 9), chunk) AS nearness
      FROM scaled, seed, scale)
    JOIN named ON chunk = prediction
    WHERE nearness = 1""",
    "segments_kmeans": """
    SELECT customerid, rfm_score, prediction, segmento,
           '(' || CAST(prediction AS VARCHAR) || ') ' || segmento AS prediction_label
    FROM (
      SELECT customerid, rfm_score,
             list_transform(centers, lambda c: round(
               pow(r - c[1], 2) + pow(f - c[2], 2) + pow(m - c[3], 2), 9)) AS distances
      FROM scaled, (SELECT centers FROM fit ORDER BY step DESC LIMIT 1))
    JOIN named ON prediction = list_position(distances, list_min(distances)) - 1""",
    "metrics_kmeans": """
    SELECT customerid, recency, frequency, monetary, prediction, segmento
    FROM (
      SELECT vector.*,
             list_transform(centers, lambda c:
               pow(r - c[1], 2) + pow(f - c[2], 2) + pow(m - c[3], 2)) AS distances
      FROM vector, (SELECT centers FROM drift ORDER BY step DESC LIMIT 1))
    JOIN named ON prediction = list_position(distances, list_min(distances)) - 1
    WHERE customerid IS NOT NULL""",
    "metrics_centroids": """
    SELECT CAST(k - 1 AS INTEGER) AS prediction, round(centers[k][1], 6) AS r,
           round(centers[k][2], 6) AS f, round(centers[k][3], 6) AS m
    FROM (SELECT centers FROM drift ORDER BY step DESC LIMIT 1),
         (SELECT unnest([1, 2, 3, 4, 5, 6]) AS k)""",
    "analysis_dataset": """
    SELECT * REPLACE (CAST(originalamount AS DOUBLE) AS originalamount,
                      CAST(extendedamount AS DOUBLE) AS extendedamount,
                      CAST(totaldiscount AS DOUBLE) AS totaldiscount)
    FROM dataset""",
    "spend_share": """
    SELECT segmento, CAST(spend AS DOUBLE) AS spend_by_segment,
           CAST(total AS DOUBLE) AS total_spend,
           CAST(spend AS DOUBLE) / CAST(total AS DOUBLE) AS spend_fraction
    FROM (SELECT segmento, sum(CAST(monetary AS DECIMAL(34,4))) AS spend FROM prediction
          GROUP BY segmento),
         (SELECT sum(CAST(monetary AS DECIMAL(34,4))) AS total FROM prediction)""",
    "customer_share": """
    SELECT segmento, count(customerid) AS customer_count,
           (SELECT count(*) FROM prediction) AS total_customer_count,
           CAST(count(customerid) AS DOUBLE) / (SELECT count(*) FROM prediction)
             AS customer_fraction
    FROM prediction GROUP BY segmento""",
    "rfm_means": """
    SELECT segmento, round(avg(frequency), 6) AS frequency_avg,
           round(avg(monetary), 6) AS monetary_avg, round(avg(recency), 6) AS recency_avg
    FROM prediction GROUP BY segmento""",
    "age_mean": """
    SELECT segmento, round(avg(age), 6) AS age_avg
    FROM (SELECT DISTINCT segmento, customerid, age FROM dataset WHERE age IS NOT NULL)
    GROUP BY segmento""",
    "gender_share": """
    SELECT segmento, new_gender, gender_count, total_gender_count,
           CAST(gender_count AS DOUBLE) / total_gender_count AS gender_fraction
    FROM (SELECT segmento, CASE gender WHEN 'M' THEN 'Male' ELSE 'Female' END AS new_gender,
                 count(DISTINCT customerid) AS gender_count
          FROM dataset WHERE gender IN ('M', 'F') GROUP BY ALL)
    JOIN (SELECT segmento, count(DISTINCT customerid) AS total_gender_count
          FROM dataset WHERE gender IN ('M', 'F') GROUP BY segmento) USING (segmento)""",
    "top_families": _families("DESC"),
    "last_families": _families("ASC"),
    "products_per_ticket": """
    SELECT segmento, round(avg(per_ticket), 6) AS avg_purchase_count
    FROM (SELECT segmento, customerid,
                 CAST(count(productid) AS DOUBLE) / nullif(count(DISTINCT ticketid), 0)
                   AS per_ticket
          FROM (SELECT DISTINCT segmento, customerid, ticketid, productid, quantity FROM dataset)
          GROUP BY segmento, customerid)
    GROUP BY segmento""",
    "vat_share": _share(
        """SELECT DISTINCT segmento, customerid, ticketid, productid, vatdescription FROM dataset
           WHERE vatdescription IS NOT NULL""",
        "vatdescription",
    ),
    "health_share": _share(
        """SELECT DISTINCT segmento, customerid, ticketid, productid, healthy, unhealthy
           FROM dataset WHERE healthy IS NOT NULL""",
        "healthy, unhealthy",
    ),
    "discount_share": _share(
        """SELECT segmento, ticketid, productid,
                  CASE WHEN sum(originalamount) - sum(extendedamount) > 0 THEN 'YES' ELSE 'NO' END
                    AS discount
           FROM (SELECT DISTINCT segmento, customerid, ticketid, productid, originalamount,
                        extendedamount
                 FROM dataset WHERE originalamount IS NOT NULL)
           GROUP BY segmento, ticketid, productid""",
        "discount",
    ),
    "total_spend_millions": """
    SELECT CAST(sum(extendedamount) AS DOUBLE) / 1000000 AS total_in_millions FROM dataset""",
    "top_articles": """
    SELECT * FROM (
      SELECT *, rank() OVER (PARTITION BY segmento ORDER BY product_count DESC) AS rank
      FROM (SELECT segmento, article, count(article) AS product_count FROM dataset
            WHERE article IS NOT NULL GROUP BY ALL))
    WHERE rank <= 5""",
    "city_customers": """
    SELECT city, segmento, customer_count,
           CAST(sum(customer_count) OVER (PARTITION BY city) AS BIGINT) AS total_city
    FROM (SELECT city, segmento, count(DISTINCT customerid) AS customer_count FROM dataset
          WHERE city IS NOT NULL GROUP BY ALL)""",
    "age_gender_bands": """
    SELECT segmento,
           CASE WHEN age < 18 THEN 'Menor de 18' WHEN age < 35 THEN 'Entre 18-34'
                WHEN age < 50 THEN 'Entre 35-49' WHEN age < 65 THEN 'Entre 50-64'
                ELSE 'Mayor de 65' END AS age_range,
           gender, count(DISTINCT customerid) AS customer_count
    FROM dataset WHERE gender = 'M' OR (gender = 'F' AND age IS NOT NULL)
    GROUP BY ALL""",
}


# The jobs and files must give what the operators give without them.
for _name in ("train_segments_folder", "train_plain_folders", "run_predictions", "run_threshold_folders"):
    _BODIES[_name] = _BODIES["segments_kmeans"]
_BODIES["train_predictions"] = f"""
    SELECT s.*, l.prediction, l.segmento, l.prediction_label
    FROM scored s JOIN ({_BODIES["segments_kmeans"]}) l ON s.customerid = l.customerid"""
_BODIES["reports_from_files"] = _BODIES["health_share"]
_BODIES["city_customers_bitmaps"] = _BODIES["city_customers"]
_BODIES["age_gender_bitmaps"] = _BODIES["age_gender_bands"]


def oracle_sql() -> dict[str, str]:
    return {name: _query(body) for name, body in _BODIES.items()}
