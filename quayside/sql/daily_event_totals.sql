-- Events and value per effective date and event type of a loaded event table.
SELECT effective_date,
       event_type,
       count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS value_total
FROM IDENTIFIER(:source_table)
GROUP BY effective_date, event_type
